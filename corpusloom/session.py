"""Session helpers: table access and materialisation in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_tables: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir`` (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as named in ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a local folder is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = "file://" + folder
        spark.sparkContext.setCheckpointDir(named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as parquet and read it again.

    This cuts lineage in a way that survives lost executors, keeps columns prunable and
    takes less disk than a row checkpoint.  ``release`` deletes what was written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/corpusloom/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_bucketed(df: DataFrame, column: str) -> DataFrame:
    """As ``materialise``, but in buckets of ``column``: joins on it read the table unshuffled.

    Meant for the result of an aggregation by ``column``, whose shuffle already forms the buckets.
    """
    spark = df.sparkSession
    name = f"corpusloom_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/corpusloom/{name}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).format("parquet").bucketBy(n, column).saveAsTable(name)
    _written.append(path)
    _tables.append(name)
    return spark.table(name)


def release(spark: SparkSession) -> int:
    """Delete everything ``materialise`` wrote in this process; returns the number of folders.

    Call it once no DataFrame built on them is needed any more.
    """
    while _tables:
        spark.sql(f"drop table if exists {_tables.pop()}")
    jvm, n = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine, as the tests and ``bench.py`` use it."""
    os.environ.setdefault("TZ", "UTC")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
