import math
import random

from pyspark.sql import functions as F

from corpusloom.llm import topn


def brute(rows, n):
    best = {}
    for g, i, s in rows:
        if g is None or i is None or s is None or math.isnan(s):
            continue
        best[g, i] = max(best.get((g, i), -math.inf), s + 0.0)
    out = set()
    for g in {g for g, _ in best}:
        out |= {(g, i) for i, _ in sorted(((i, s) for (h, i), s in best.items() if h == g), key=lambda x: (-x[1], x[0]))[:n]}
    return out


def run(spark, rows, n, **k):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "g string, i string, s double, group string, salt int")
    got = [(r.group, r.item) for r in topn.top_n(df, F.col("g"), F.col("i"), F.col("s"), n, **k).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_edges(spark):
    rows = [("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", 2.0), ("a", "é", 2.0), ("a", "Z", 2.0), (None, "x", 1.0), ("b", None, 1.0), ("b", "x", None), ("c", "x", math.nan), ("d", "x", math.inf), ("d", "y", -math.inf), ("e", "x", -0.0), ("e", "a", 0.0), ("", "", 1.0)]
    for n in (1, 2, 10):
        assert run(spark, rows, n) == brute(rows, n)
    assert run(spark, [], 3) == set()


def test_hot_group_with_ties(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(300)}", f"p{rng.randrange(4000)}", rng.randrange(50) / 50) for _ in range(20_000)]
    for salts in (1, 16):
        assert run(spark, rows, 10, salts=salts) == brute(rows, 10)
