import random

import regex

from corpusloom.llm import leaks


def brute(docs, items, run):
    w = lambda t: regex.findall(r"[\p{L}\p{N}]+", t.lower()) if t else []
    grams = {}
    for i, t in items:
        x = w(t)
        for k in range(len(x) - run + 1):
            grams.setdefault(tuple(x[k : k + run]), set()).add(i)
    return {(d, i) for d, t in docs for x in [w(t)] for k in range(len(x) - run + 1) for i in grams.get(tuple(x[k : k + run]), ())}


def run_(spark, docs, items, run, window=48):
    d = spark.createDataFrame([(k, t, "clash") for k, t in docs], "doc_id long, text string, t string")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in leaks.find_leaks(d, "doc_id", "text", i, "item_id", "text", run, window).collect()]
    assert len(got) == len(set(got)) or len(docs) != len({k for k, _ in docs})
    return set(got)


def test_random(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(3, 60)))) for i in range(60)]
    docs = []
    for d in range(200):
        w = [rng.choice(words + ["zz"]) for _ in range(rng.randrange(0, 150))]
        if rng.random() < 0.5:
            x = rng.choice(items)[1].split()
            a = rng.randrange(len(x))
            at = rng.randrange(len(w) + 1)
            w[at:at] = x[a : a + rng.randrange(1, 30)]
        docs.append((d, ", ".join(w)))
    for run, window in ((12, 48), (5, 5), (12, 12), (2, 30)):
        assert run_(spark, docs, items, run, window) == brute(docs, items, run)


def test_edges(spark):
    text = "Ä b c d e f g h i j k l"
    items = [(1, text), (2, text), (3, None), (4, ""), (5, "too short"), (6, "a " * 12)]
    docs = [(1, "x " + text.lower() + " y"), (2, None), (3, ""), (4, " "), (5, "ä-b.c d e f g h i j k"), (6, "a " * 50_000), (7, text), (7, text), (8, "é" * 100_000)]
    assert run_(spark, docs, items, 12) == {(1, 1), (1, 2), (6, 6), (7, 1), (7, 2)}
    assert run_(spark, [], items, 12) == set() and run_(spark, docs, [], 12) == set()


def test_postings_that_are_jumped_over_are_not_read():
    rng = random.Random(6)
    words = [f"w{int(2000 * rng.random() ** 2)}" for _ in range(4000)]
    items = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(300)]
    index = leaks.Index(items)
    docs = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(40)] + [items[7] + " " + items[8]]
    text, item, read, total = index.leaks(docs, 20)
    assert set(zip(text.tolist(), item.tolist(), strict=True)) == brute(enumerate(docs), enumerate(items), 12)
    assert 0 < read < 0.8 * total


def test_several_indexes_and_keys_of_text(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    items = [(f"k{i}", " ".join(rng.choice(words) for _ in range(20))) for i in range(50)] + [(None, "w1 " * 20)]
    docs = [(d, items[d][1]) for d in range(20)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item string, text string")
    for budget in (10**9, 1000):
        got = [(r.doc_id, r.item) for r in leaks.find_leaks(d, "doc_id", "text", i, "item", "text", budget=budget).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(docs, items[:-1], 12)
