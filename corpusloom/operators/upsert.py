"""Keyed merges, provenance and snapshot deltas over plain DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (ignore later ones)."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_r = 1").drop("_r")


def upsert(target: DataFrame, updates: DataFrame, key: list[str], update: list[str], keep: list[str] = (), add: list[str] = ()) -> DataFrame:
    """Insert new keys; on known keys take ``update`` columns from ``updates`` and leave the rest.

    Columns in ``keep`` take the existing value and only fill nulls, those in ``add`` are summed.  ``updates`` must have
    one row per key (see ``keep_first``).
    """
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("t_in"))
    u = updates.select(*[F.col(c).alias(f"u_{c}") for c in target.columns], F.lit(True).alias("u_in"))
    on = [F.col(f"t_{k}") == F.col(f"u_{k}") for k in key]
    j = t.join(u, on, "full")
    out = []
    for c in target.columns:
        if c in key:
            v = F.coalesce(f"t_{c}", f"u_{c}")
        elif c in update:
            v = F.when(F.col("u_in"), F.col(f"u_{c}")).otherwise(F.col(f"t_{c}"))
        elif c in add:
            v = F.coalesce(F.col(f"t_{c}"), F.lit(0)) + F.coalesce(F.col(f"u_{c}"), F.lit(0))
        elif c in keep:
            v = F.when(F.col("t_in"), F.coalesce(f"t_{c}", f"u_{c}")).otherwise(F.col(f"u_{c}"))
        else:
            v = F.when(F.col("t_in"), F.col(f"t_{c}")).otherwise(F.col(f"u_{c}"))
        out.append(v.alias(c))
    return j.select(*out)


def ledger(df: DataFrame, source: str, key: str) -> DataFrame:
    """(source_id, record_count, stored_count): rows read and distinct keys stored of each source."""
    return df.groupBy(F.col(source).alias("source_id")).agg(F.count(F.lit(1)).alias("record_count"), F.countDistinct(key).alias("stored_count"))


def snapshot_delta(before: DataFrame, after: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, before, after, delta) for all keys of either snapshot, 0 where missing."""
    b = before.select(*key, F.col(value).alias("before"))
    a = after.select(*key, F.col(value).alias("after"))
    j = b.join(a, key, "full").select(*key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return j.withColumn("delta", F.col("after") - F.col("before"))


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done yet (null-safe, unlike NOT IN)."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rejects carry the name of the first rule they break as ``reason``."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(reason)
    marked = df.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")
