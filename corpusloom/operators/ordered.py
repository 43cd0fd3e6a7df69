"""Order over whole tables without a single-task sort: ranks and predecessors by range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialise


def _ranged(df: DataFrame, order: list[Column], parts: int | None) -> DataFrame:
    """Rows with the number of their range of ``order``, written once so that ranges stay the same."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in ``order``, which must leave no ties.

    Rows are numbered within ranges of the order; the ranges' sizes (one row each) give offsets.
    """
    r = _ranged(df, order, parts)
    sizes = r.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return r.withColumn("_own", own).join(offsets, "_range").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_own", "_before", "_range")


def previous(df: DataFrame, by: str, order: str, value: str, name: str, parts: int | None = None) -> DataFrame:
    """Add the ``value`` of the row before within ``by``, in ``order`` (no ties), null for the first.

    However large a ``by`` group is, it is spread over ranges; only the last value of each
    (group, range) is carried to the next.
    """
    r = _ranged(df, [F.col(by), F.col(order)], parts)
    inner = Window.partitionBy("_range", by).orderBy(order)
    r = r.withColumns({"_lag": F.lag(value).over(inner), "_first": F.row_number().over(inner) == 1})
    last = r.groupBy("_range", by).agg(F.max_by(value, order).alias("_last"))
    carried = last.withColumn("_carried", F.lag("_last").over(Window.partitionBy(by).orderBy("_range"))).drop("_last")
    j = r.join(carried, ["_range", by], "left")
    return j.withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag"))).drop("_range", "_lag", "_first", "_carried")
