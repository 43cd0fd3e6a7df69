import random

import pytest

from corpusloom.llm import tokens

pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def enc():
    try:
        ranks = open(tokens.DEFAULT_PATH, "rb").read()
    except OSError:
        pytest.skip("no vocabulary file")
    return tokens._encoding(ranks, tokens.PATTERN)


ALPHABETS = ["ab", "a", "aé日本", "日本語の町", "a1-'s ", "don't we'll ", "!?'-", "0123", " \n\t ", "👨‍🌾é", "abcdefgh ,."]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_tree_join_equals_direct_encoding(enc, alphabet):
    rng = random.Random(alphabet)
    for n in (0, 1, 7, 50, 333, 2000):
        for piece, unsplit in ((1, 1), (10, 3), (64, 10), (1000, 64), (64, 5000)):
            if n / unsplit > 400:
                continue
            text = "".join(rng.choice(alphabet) for _ in range(n))
            parts = tokens.segments(text, piece, unsplit)
            assert "".join(p for x in parts for p in x) == text
            assert all(len(p) <= max(piece, unsplit) for x in parts for p in x)
            got = [t for x in parts for t in tokens.tree_join([enc.encode_ordinary(p) for p in x], enc.encode_ordinary, enc.decode_bytes)]
            assert got == enc.encode_ordinary(text)


def test_encode_corpus(spark, enc):
    rng = random.Random(5)
    mixed = "".join(rng.choice("abcdé日本0'!") for _ in range(3000))
    texts = [None, "", "  ", "<|endoftext|>", "x" * 5000, "the cat's " * 700, "日本" * 900, "the cat", "the cat", f"a {mixed} b\n{mixed[:700]} c", " " * 900, mixed + " " * 600 + "end"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    for limits in ({"piece": 300}, {"piece": 300, "unsplit": 50}, {}):
        got = {r.doc_id: list(r.ids) for r in tokens.encode_corpus(df, "doc_id", "text", **limits).collect()}
        assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert tokens.pieces(df, "doc_id", "text").filter("_n > 1").select("_row").distinct().count() == 5
    assert tokens.encode_corpus(df.limit(0), "doc_id", "text").count() == 0
