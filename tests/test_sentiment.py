import pytest
from pyspark.sql import functions as F

from corpusloom.functions import sentiment as S

LEXICON = {"good": 2.0, "bad": -2.0, "very": 9.0}


def want(total):
    return round(total / (total * total + 15) ** 0.5, 4) if total else 0.0


@pytest.mark.parametrize(
    ("text", "total"),
    [
        ("a good day", 2.0), ("a very good day", 2.293), ("very, so good", 2 + 0.293 + 0.293 * 0.95), ("very much a good day", 2 + 0.293 * 0.9), ("a barely bad day", -2 + 0.293),
        ("a GOOD day", 2.733), ("A GOOD DAY", 2.0), ("a VERY good day", 2 + 0.293 + 0.733), ("not good", -1.48), ("isn't a good day", -1.48), ("not bad", 1.48),
        ("not very good", (2 + 0.293) * -0.74), ("good but bad", 1 - 3), ("good!!", 2 + 0.584), ("bad!!!!!!", -2 - 4 * 0.292), ("good??", 2.36), ("good????", 2.96), ("good?", 2.0),
        ("", 0), ("  ", 0), ("!!!", 0), ("plain words", 0), ("good " * 3, 6.0), ("one two three not four good", -1.48), ("not one two three good", 2.0), ("'good'", 2.0),
    ],
)
def test_rules(text, total):
    assert S.Scorer(LEXICON).score(text) == pytest.approx(want(total), abs=1e-4)


def test_column(spark):
    df = spark.createDataFrame([(None,), ("good",), ("x" * 100_000 + " bad",), ("good",)], "text string")
    assert [r[0] for r in df.select(S.sentiment(F.col("text"), LEXICON)).collect()] == [None, want(2), want(-2), want(2)]
    assert df.limit(0).select(S.sentiment(F.col("text"), LEXICON)).collect() == []
