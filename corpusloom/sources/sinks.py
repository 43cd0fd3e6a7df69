"""Writers: full refresh, JSON payloads, vectors with ids, delimited manifests, attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Delete all and write again."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def payload(df: DataFrame, columns: list[str], name: str = "payload") -> DataFrame:
    """One compact JSON document a row."""
    return df.select(F.to_json(F.struct(*columns)).alias(name))


def dictionary(df: DataFrame, key: str, value: Column) -> DataFrame:
    """One JSON object of a small catalog: key -> value."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    return df.filter(F.col(key).isNotNull()).agg(F.to_json(F.map_from_entries(entries)).alias("payload"))


def manifest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lines with ``|`` between fields; ``|`` within a field becomes a blank."""
    return df.select(F.concat_ws("|", *[F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit(" ")) for c in columns]).alias("line"))


def write_manifest(df: DataFrame, columns: list[str], path: str) -> None:
    manifest(df, columns).write.mode("overwrite").text(path)


def vectors(df: DataFrame, key: str, vector: str, path: str) -> None:
    """Vectors with their ids beside them, in one file set."""
    df.select(F.col(key), F.col(vector).cast("array<float>")).write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def merge_manifest(spark: SparkSession, path: str, entries: DataFrame, key: str) -> None:
    """Add the ``entries`` whose key a stored manifest lacks; those that it has stand.

    New entries are appended as files of their own, so a run that breaks off leaves the stored ones untouched.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        done = spark.read.schema(entries.schema).parquet(path).select(key).distinct()
        entries = entries.join(done, key, "left_anti")
    entries.write.mode("append").parquet(path)
