"""Vector expressions and multi-label assignment by similarity to centroids."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def centroids(df: DataFrame, label: str, vector: str, eps: float = 1e-9) -> DataFrame:
    """(label, centroid): the mean vector of each label, scaled to length 1.

    Elements are averaged by position with map-side combine; a label's result is one vector.
    """
    parts = df.select(F.col(label).alias("label"), F.posexplode(vector).alias("pos", "x")).groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    whole = parts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("p")).select("label", F.transform("p", lambda e: e["m"]).alias("m"))
    return whole.select("label", F.transform("m", lambda x: x / (norm(F.col("m")) + eps)).alias("centroid"))


def similarities(df: DataFrame, key: str, vector: str, labels: DataFrame, digits: int = 6, max_labels: int = 10_000) -> DataFrame:
    """(key, label, score) of every vector against every label of a catalog of centroids.

    The catalog has one row a label.  It is sent to the executors, where each Arrow batch is scored by one matrix
    product; one of more than ``max_labels`` is divided by a hash of the label, and the vectors are read for each part.
    Vectors that are null, of another length or all zero score 0.
    """
    catalog = labels.select("label", F.col("centroid").cast("array<double>").alias("centroid")).orderBy("label")
    rows = catalog.limit(max_labels + 1).collect()
    if len(rows) <= max_labels:
        return _scored(df, key, vector, labels, rows, digits)
    # On average half of what is allowed, so that no part exceeds it by chance.
    parts = -(-2 * labels.count() // max_labels)
    share = lambda i: catalog.filter(F.pmod(F.xxhash64("label"), F.lit(parts)) == i).collect()
    return functools.reduce(DataFrame.unionByName, [_scored(df, key, vector, labels, share(i), digits) for i in range(parts)])


def _scored(df: DataFrame, key: str, vector: str, labels: DataFrame, catalog: list, digits: int) -> DataFrame:
    key_type, label_type = (d.schema[c].dataType for d, c in ((df, key), (labels, "label")))
    names = pa.array([r.label for r in catalog], to_arrow_type(label_type))
    dim = len(catalog[0].centroid) if catalog else 0
    shared = df.sparkSession.sparkContext.broadcast(np.array([r.centroid for r in catalog], float).reshape(len(catalog), dim))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000) if len(c) else ():
                batch = whole.slice(at, 2000)
                n = batch.num_rows
                lists = batch.column(vector)
                good = pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False).to_numpy(zero_copy_only=False)
                x = np.zeros((n, dim))
                x[good] = lists.filter(pa.array(good)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
                length = np.sqrt((x * x).sum(axis=1, keepdims=True))
                s = np.round(x @ c.T / np.where(length > 0, length, 1.0), digits)
                rows, cols = np.repeat(np.arange(n), len(c)), np.tile(np.arange(len(c)), n)
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows)), names.take(pa.array(cols)), pa.array(s.ravel())], [key, "label", "score"])

    return df.select(key, vector).mapInArrow(score, f"`{key}` {key_type.simpleString()}, label {label_type.simpleString()}, score double")


def assign_labels(scores: DataFrame, key: str, top_k: int = 3, threshold: float = 0.25, forced: DataFrame | None = None, default: str = "general", guarantee: bool = False) -> DataFrame:
    """(key, label, score, rank): up to ``top_k`` labels at or above ``threshold``, ties by label.

    ``forced`` (key, label) is admitted at any score; with ``guarantee`` forced labels also go
    before better ones.  Items without a label get ``default`` with score 0.0 and rank 1.
    """
    s = scores
    if forced is None:
        s = s.withColumn("_f", F.lit(False))
    else:
        s = s.join(forced.select(key, "label").distinct().withColumn("_f", F.lit(True)), [key, "label"], "left").withColumn("_f", F.coalesce("_f", F.lit(False)))
    order = [F.desc("_f")] if guarantee else []
    eligible = s.filter((F.col("score") >= threshold) | F.col("_f"))
    best = eligible.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order, F.desc("score"), "label"))).filter(F.col("rank") <= top_k)
    rest = scores.select(key).distinct().join(best.select(key).distinct(), key, "left_anti")
    return best.select(key, F.col("label").cast("string").alias("label"), "score", "rank").unionByName(rest.select(key, F.lit(default).alias("label"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")))
