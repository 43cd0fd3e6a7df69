"""Ordered phrase-rule catalogs applied to texts in one projection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    pattern: str
    target: str
    polarity: str


def matches(df: DataFrame, key: str, text: str, rules: list[Rule], flags: str = "(?iuUd)") -> DataFrame:
    """(key, surface, target, polarity): the first match of each rule; of rules with equal target and
    polarity the first in the catalog gives the surface.

    The catalog becomes one projection: a prefilter of all patterns, then one array of hits a row.
    """
    anything = flags + "|".join(f"(?:{r.pattern})" for r in rules)
    hits = F.array(
        *[F.struct(F.lit(i).alias("ordinal"), F.lit(r.target).alias("target"), F.lit(r.polarity).alias("polarity"), F.regexp_extract(F.col(text), f"{flags}({r.pattern})", 1).alias("surface")) for i, r in enumerate(rules)]
    )
    found = df.filter(F.col(text).rlike(anything)).select(key, F.explode(hits).alias("h")).filter("h.surface <> ''")
    return found.groupBy(key, F.col("h.target").alias("target"), F.col("h.polarity").alias("polarity")).agg(F.min_by("h.surface", "h.ordinal").alias("surface"))


def leaderboard(hits: DataFrame, key: str, n: int = 30) -> DataFrame:
    """Targets by number of hits, with the commoner polarity (ties: the smaller name)."""
    per = hits.groupBy("target", "polarity").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("target").agg(F.sum("n").alias("n_hits"), F.min_by("polarity", F.struct(-F.col("n"), F.col("polarity"))).alias("polarity")).orderBy(F.desc("n_hits"), "target").limit(n)


def shared_surfaces(hits: DataFrame, n: int = 20) -> DataFrame:
    """Lower-cased surfaces that stand for more than one target."""
    g = hits.groupBy(F.lower("surface").alias("surface")).agg(F.countDistinct("target").alias("n_targets"), F.count(F.lit(1)).alias("total"), F.array_join(F.sort_array(F.collect_set("target")), ",").alias("targets"))
    return g.filter("n_targets > 1").orderBy(F.desc("total"), "surface").limit(n)
