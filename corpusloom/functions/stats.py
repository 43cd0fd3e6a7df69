"""Statistics that the built-in aggregates don't have, as expressions and window compositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exclusive_decile(values: Column, k: int = 9) -> Column:
    """The k-th decile by the exclusive method of an array; null for fewer than two values.

    With n sorted values: j = floor(k (n + 1) / 10), kept within 1 and n - 1; d = k (n + 1) - 10 j;
    (x_j (10 - d) + x_j+1 d) / 10.
    """
    x, n = F.array_sort(values), F.size(values)
    j = F.least(F.greatest(F.floor(F.lit(k) * (n + 1) / 10).cast("int"), F.lit(1)), n - 1)
    d = F.lit(k) * (n + 1) - j * 10
    return F.when(n >= 2, (F.get(x, j - 1) * (10 - d) + F.get(x, j) * d) / 10)


def exclusive_decile_by(df: DataFrame, by: list[str], value: str, k: int = 9, name: str = "decile") -> DataFrame:
    """(by, n, top, name): the exclusive k-th decile and the maximum of ``value`` per group.

    Equal values are counted first (map-side combine), then the counts are run through in order
    until the two order statistics, so no group is ever gathered as a list.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    n = counts.groupBy(*by).agg(F.sum("_c").alias("n"), F.max(value).alias("top"))
    seen = F.sum("_c").over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    j = F.least(F.greatest(F.floor(F.lit(k) * (F.col("n") + 1) / 10), F.lit(1)), F.col("n") - 1)
    r = counts.withColumn("_seen", seen).join(n, by).withColumn("_j", j)
    low = F.min(F.when(F.col("_seen") >= F.col("_j"), F.col(value)))
    high = F.min(F.when(F.col("_seen") >= F.col("_j") + 1, F.col(value)))
    d = F.lit(k) * (F.col("n") + 1) - F.col("_j") * 10
    g = r.groupBy(*by, "n", "top", "_j").agg(low.alias("_x"), high.alias("_y"))
    return g.withColumn(name, F.when(F.col("n") >= 2, (F.col("_x") * (10 - d) + F.col("_y") * d) / 10)).select(*by, "n", "top", name)


def quantiles_by(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(by, n, mean, the names of ``shares``): quantiles interpolated between the order statistics around share (n - 1).

    As in ``exclusive_decile_by`` equal values are counted first and the counts run through in order.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    n = counts.groupBy(*by).agg(F.sum("_c").alias("n"), (F.sum(F.col(value) * F.col("_c")) / F.sum("_c")).alias("mean"))
    seen = F.sum("_c").over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    r = counts.withColumn("_seen", seen).join(n, by)
    at = {k: F.lit(p) * (F.col("n") - 1) for k, p in shares.items()}
    first = lambda place: F.min(F.when(F.col("_seen") > place, F.col(value)))
    ends = [x for k in shares for x in (first(F.floor(at[k])).alias(f"_low_{k}"), first(F.ceil(at[k])).alias(f"_high_{k}"))]
    g = r.groupBy(*by, "n", "mean").agg(*ends)
    return g.select(*by, "n", "mean", *[(F.col(f"_low_{k}") + (at[k] - F.floor(at[k])) * (F.col(f"_high_{k}") - F.col(f"_low_{k}"))).alias(k) for k in shares])


def zscore_within(df: DataFrame, value: str, by: list[str], name: str = "z") -> DataFrame:
    """Population z-score of ``value`` within groups; a deviation of 0 counts as 1."""
    w = Window.partitionBy(*by)
    sd = F.stddev_pop(value).over(w)
    return df.withColumn(name, (F.col(value) - F.avg(value).over(w)) / F.when(sd == 0, 1.0).otherwise(sd))


def rolling_mean(df: DataFrame, value: str, order: str, rows: int = 3, by: list[str] | None = None, name: str = "rolling") -> DataFrame:
    """Mean over the row and those before it (shorter at the start)."""
    return df.withColumn(name, F.avg(value).over(Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(-(rows - 1), 0)))


def mode_by(df: DataFrame, by: list[str], value: str, name: str = "mode") -> DataFrame:
    """The most frequent value per group; ties go to the smallest value."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; Spark prunes before the shuffle (window group limit)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= n)


def running_cutoff(df: DataFrame, by: list[str], order: list[Column], value: str, target: float) -> DataFrame:
    """Rows of each group in order, as long as the total before the row is below ``target``."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(value).over(w), F.lit(0.0))).filter(F.col("before") < target)


def dense(df: DataFrame, axes: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """All combinations of small, distinct axes with ``value`` 0 where ``df`` has no row.

    The axes are report axes (hours, months, labels); their product is the size of the report.
    """
    grid = axes[0]
    for a in axes[1:]:
        grid = grid.join(a)
    return grid.join(df, keys, "left").withColumn(value, F.coalesce(value, F.lit(0)))
