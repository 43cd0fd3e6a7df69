"""Streaming ingestion: landed files are merged into a keyed table as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import upsert


def stream_upsert(spark: SparkSession, source: str, schema: str, target: str, key: list[str], order: list[Column], update: list[str], checkpoint: str, keep: list[str] = (), add: list[str] = (), files_per_batch: int | None = None) -> None:
    """Process all landed parquet files not yet seen and merge them into versions of ``target``.

    Each micro-batch (of ``files_per_batch`` files, in the order of their times) reads the latest version and
    writes the next (``v=<batch>``), so a restarted batch overwrites its own version only and readers never see
    half a table.  Versions before the last two are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        first = upsert.keep_first(batch, key, order)
        if add:
            # Of the rows of a key in one batch one stands for all, but all are counted.
            first = first.drop(*add).join(batch.groupBy(*key).agg(*[F.sum(c).alias(c) for c in add]), key).select(*batch.columns)
        before = latest(spark, target, number)
        merged = first if before is None else upsert.upsert(before, first, key, update, list(keep), list(add))
        merged.write.mode("overwrite").parquet(f"{target}/v={number}")
        path, fs = _at(spark, target)
        for old in versions(spark, target)[:-2]:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"v={old}"), True)

    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _at(spark: SparkSession, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, target: str) -> list[int]:
    """The numbers of the versions that there are, in order."""
    path, fs = _at(spark, target)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def latest(spark: SparkSession, target: str, below: int | None = None) -> DataFrame | None:
    """The newest version of a table written by ``stream_upsert`` (older than ``below``)."""
    found = [v for v in versions(spark, target) if below is None or v < below]
    return spark.read.parquet(f"{target}/v={found[-1]}") if found else None


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts with a watermark; works on streams and on tables."""
    w = events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), key, "n")


def stream_windows(spark: SparkSession, source: str, schema: str, ts: str, key: str, target: str, checkpoint: str, width: str = "1 hour", late: str = "10 minutes", files_per_batch: int | None = None) -> None:
    """Tumbling counts of landed parquet files, kept in versions of ``target`` (start, ``key``, n).

    Windows stay open for rows that are ``late``; each micro-batch emits the windows it changed, and these replace those
    of the version before.  Rows later than that are dropped by the watermark.
    """

    def merge(batch: DataFrame, number: int) -> None:
        before = latest(spark, target, number)
        merged = batch if before is None else upsert.upsert(before, batch, ["start", key], ["n"])
        merged.write.mode("overwrite").parquet(f"{target}/v={number}")
        path, fs = _at(spark, target)
        for old in versions(spark, target)[:-2]:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"v={old}"), True)

    reader = spark.readStream.schema(schema)
    stream = windowed_counts((reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source), ts, key, width, late)
    stream.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
