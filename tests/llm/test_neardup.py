import random

import regex
from pyspark.sql import functions as F

from corpusloom.llm import neardup

S = "scope string, id string, text string, tokens string, cls int"


def sets(rows, shingle, least):
    out = {}
    for scope, key, text in rows:
        w = regex.findall(r"[\p{L}\p{N}]+", text.lower()) if text else []
        if key is not None and len(w) >= max(least, shingle):
            out[scope, key] = frozenset(tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1))
    return out


def brute(rows, t, shingle, least):
    s = sorted(sets(rows, shingle, least).items())
    return {(a[0], a[1], b[1]) for i, (a, x) in enumerate(s) for b, y in s[i + 1 :] if a[0] == b[0] and len(x & y) >= t * len(x | y) - 1e-9}


def run(spark, rows, t, shingle, least, expand=1000, **k):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], S)
    found = neardup.find(df, F.col("scope"), F.col("id"), F.col("text"), t, shingle, least, **k)
    got = [tuple(r) for r in neardup.pairs(found, expand).select("scope", "key_a", "key_b").collect()]
    assert len(got) == len(set(got))
    return set(got), found


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[2].split()
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                c = rng.randrange(len(w))
                w = w[c:] + w[:c]
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 40))]
        rows.append((rng.choice(["a", "b"]), f"id{i}", " ".join(w)))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(250, 1)
    for t, shingle, least in ((0.6, 2, 10), (0.8, 5, 1), (1.0, 2, 1)):
        assert run(spark, rows, t, shingle, least)[0] == brute(rows, t, shingle, least)


def test_long_texts_and_small_sketch(spark):
    rows = [(s, k, " ".join(x.split() * 6)) for s, k, x in corpus(40, 3, words=400)]
    assert run(spark, rows, 0.6, 2, 10, sketch_bits=4)[0] == brute(rows, 0.6, 2, 10)


def test_split_and_chunked_lists(spark):
    rows = corpus(220, 5, words=25)
    for mu in (0.0, 0.01, 0.2, 100.0):
        assert run(spark, rows, 0.6, 2, 10, hot=6, chunk=4, mu=mu)[0] == brute(rows, 0.6, 2, 10)


def test_edges(spark):
    text = "One two three four five six seven eight nine TEN"
    rows = [("a", "1", text), ("a", "2", text.lower() + "!!"), ("a", "1", text), ("b", "3", text), ("a", "4", None), ("a", "5", ""), ("a", "6", "  "), ("a", "7", "short text"), (None, "8", text), ("a", None, text), ("a", "9", "x " * 3000), ("a", "10", "x " * 5000)]
    assert run(spark, rows, 0.6, 2, 10)[0] == {("a", "1", "2"), ("a", "10", "9")}
    assert run(spark, [], 0.6, 2, 10)[0] == set()


def test_large_class_of_copies(spark):
    text = "a b c d e f g h i j k l"
    rows = [("s", f"{i:03d}", text) for i in range(40)] + [("s", "near", text + " m")]
    full, found = run(spark, rows, 0.6, 2, 10)
    assert len(full) == 41 * 40 // 2
    some, _ = run(spark, rows, 0.6, 2, 10, expand=5)
    linked = {"000"}
    for _ in range(3):
        linked |= {x for _, a, b in some for x in (a, b) if a in linked or b in linked}
    assert len(linked) == 41 and len(some) < 100
    one = {r.key: (r['class'], r.n_links) for r in neardup.classes(found).collect()}
    assert {c for c, _ in one.values()} == {"000", "near"} and all(n == 1 for _, n in one.values())
    assert [tuple(r) for r in neardup.class_links(found).collect()] == [("s", "000", "near", 11)]


def test_large_class_of_different_texts(spark):
    """Texts of one class that differ in case, punctuation or repetition are no copies."""
    text = "a b c d e f g h i j k l"
    rows = [("s", f"{i:03d}", text + "!" * i) for i in range(20)] + [("s", f"{i:03d}", text.replace("a", "A", 1) + "." * i) for i in range(20, 40)] + [("s", "near", text + " m")]
    for expand in (5, 1000):
        assert run(spark, rows, 0.6, 2, 10, expand=expand)[0] == brute(rows, 0.6, 2, 10)


def test_class_of_more_than_a_thousand_keys(spark):
    text = "a b c d e f g h i j k l"
    rows = [("s", f"{i:04d}", text + "!" * (i % 7)) for i in range(1020)] + [("s", f"x{i:04d}", text + " m") for i in range(3)]
    df = spark.createDataFrame(rows, "scope string, id string, text string")
    got = neardup.pairs(neardup.find(df, F.col("scope"), F.col("id"), F.col("text"), 0.6, 2, 10), chunk=100)
    assert got.count() == 1023 * 1022 // 2 == got.distinct().count()


def long_texts(n, seed):
    """Texts of 70 to 600 words of a common vocabulary, and of each one like it."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(70, 600))]
        rows.append(("a", f"id{i}", " ".join(w)))
        for _ in range(int(len(w) * rng.uniform(0.02, 0.2))):
            w[rng.randrange(len(w))] = f"w{rng.randrange(60)}"
        rows.append(("a", f"like{i}", " ".join(w[rng.randrange(1 + len(w) // 4) :])))
    return rows


def test_long_texts_around_the_limit(spark):
    rows = long_texts(60, 7)
    want = brute(rows, 0.6, 2, 10)
    assert 10 < len(want) < 60 and run(spark, rows, 0.6, 2, 10)[0] == want


def test_unlike_long_texts_are_not_counted(spark):
    """Signatures drop unlike pairs of long texts in the merge, before they are shuffled."""
    df = spark.createDataFrame(long_texts(60, 8), "scope string, id string, text string")
    classes = neardup._sets(df, F.col("scope"), F.col("id"), F.col("text"), 2, 10).select("cls", "tokens")
    order = neardup.Order(neardup._sketch(classes, 16), 16, 0.6, 0.01, 8192)
    cold = neardup._postings(classes, spark.sparkContext.broadcast(order), "cold")
    merged = neardup._merge(cold, cold, ["token"], 0.6)
    assert 10 < merged.filter("c >= shiftright(rule, 1)").count() and merged.count() < 200
