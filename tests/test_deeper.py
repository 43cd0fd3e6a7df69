from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.operators import places, upsert, vectors
from corpusloom.session import materialise_bucketed, release
from corpusloom.sources import readers, sinks
from corpusloom.streaming import feed

STATES = {"OH": "Ohio", "NY": "New York", "VA": "Virginia", "WV": "West Virginia"}


def test_city_state(spark):
    cases = [
        ("Rally in Dayton, OH tonight", ("Dayton", "OH")), ("New York City, New York", ("New York City", "NY")), ("in Wheeling, west virginia", ("Wheeling", "WV")), ("St. Mary's, OHIO", ("St. Mary's", "OH")),
        ("Dayton, oh well", None), ("Dayton, OHM", None), ("Paris, France", None), ("", None), (None, None), ("x" * 50_000, None), ("A, ZZ then Akron, Ohio", ("Akron", "OH")),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r.i: (r.p.city, r.p.state) for r in df.select("i", places.city_state(F.col("t"), STATES).alias("p")).collect()}
    assert got == {i: want or (None, None) for i, (_, want) in enumerate(cases)}


def test_quantiles_by(spark):
    import numpy as np

    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 7), ("d", 100)) for v in np.random.default_rng(n).integers(0, 20, n)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.q1, r.q2, r.q3) for r in stats.quantiles_by(df, ["g"], "v", {"q1": 0.25, "q2": 0.5, "q3": 1.0}).collect()}
    for g, (n, *q) in got.items():
        own = [v for k, v in rows if k == g and v is not None]
        assert n == len(own) and np.allclose(q, np.quantile(own, [0.25, 0.5, 1.0]))


def test_add_and_keep(spark):
    t = spark.createDataFrame([("a", 1, "x", 5), ("b", None, None, None)], "id string, n int, keep string, sum int")
    u = spark.createDataFrame([("a", 2, "y", 1), ("b", 3, "z", 2), ("c", 4, "w", 3)], "id string, n int, keep string, sum int")
    got = sorted(tuple(r) for r in upsert.upsert(t, u, ["id"], ["n"], ["keep"], ["sum"]).collect())
    assert got == [("a", 2, "x", 6), ("b", 3, "z", 2), ("c", 4, "w", 3)]


def test_stream_of_several_batches(spark, tmp_path):
    root = f"file://{tmp_path}"
    for k in range(5):
        spark.createDataFrame([("a", k, 1), (f"n{k}", k, 1), (f"n{k}", k, 1)], "id string, v int, c long").coalesce(1).write.mode("append").parquet(f"{root}/landed")
    run = lambda: feed.stream_upsert(spark, f"{root}/landed", "id string, v int, c long", f"{root}/table", ["id"], [F.desc("v")], ["v"], f"{root}/offsets", add=["c"], files_per_batch=1)
    run()
    assert feed.versions(spark, f"{root}/table") == [3, 4]
    want = {("a", 4, 5), *((f"n{k}", k, 2) for k in range(5))}
    assert {tuple(r) for r in feed.latest(spark, f"{root}/table").collect()} == want
    run()
    assert {tuple(r) for r in feed.latest(spark, f"{root}/table").collect()} == want


def test_cached_lookup(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    cache = spark.createDataFrame([("a", "1"), ("x", None)], "k string, v string")
    source = spark.createDataFrame([("a", "never"), ("b", "2")], "k string, v string")
    found, grown = readers.cached_lookup(keys, cache, source)
    assert {tuple(r) for r in found.collect()} == {("a", "1", True), ("b", "2", False), ("c", None, False)}
    again, same = readers.cached_lookup(keys, grown, source.limit(0))
    assert {tuple(r) for r in again.collect()} == {("a", "1", True), ("b", "2", True), ("c", None, True)} and same.count() == 4


def test_merge_manifest(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    for rows in ([("a", 1)], [("a", 2), ("b", 2)], []):
        sinks.merge_manifest(spark, path, spark.createDataFrame(rows, "id string, run int"), "id")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]


def test_release_drops_tables(spark):
    before = len(spark.catalog.listTables())
    t = materialise_bucketed(spark.range(10).withColumnRenamed("id", "k"), "k")
    assert t.count() == 10 and len(spark.catalog.listTables()) == before + 1
    # Only this table, as others may be in use.
    import corpusloom.session as session

    written, session._written = session._written[:-1], session._written[-1:]
    tables, session._tables = session._tables[:-1], session._tables[-1:]
    release(spark)
    session._written, session._tables = written, tables
    assert len(spark.catalog.listTables()) == before


def test_more_labels_than_one_broadcast_takes(spark):
    e = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)], i % 40) for i in range(200)], "k int, v array<double>, label int")
    c = vectors.centroids(e, "label", "v")
    some = {tuple(r) for r in vectors.similarities(e, "k", "v", c, max_labels=10).collect()}
    assert len(some) == 200 * 40 and some == {tuple(r) for r in vectors.similarities(e, "k", "v", c).collect()}


def test_stream_of_windows(spark, tmp_path):
    root = f"file://{tmp_path}"
    for k in range(4):
        rows = [(f"2024-01-01 0{h}:{10 + k}:00", "a" if h % 2 else "b") for h in range(5)]
        spark.createDataFrame(rows, "t string, kind string").select(F.to_timestamp("t").alias("ts"), "kind").coalesce(1).write.mode("append").parquet(f"{root}/landed")
    feed.stream_windows(spark, f"{root}/landed", "ts timestamp, kind string", "ts", "kind", f"{root}/table", f"{root}/offsets", late="1 day", files_per_batch=1)
    got = feed.latest(spark, f"{root}/table").select(F.hour("start").alias("h"), "kind", "n").collect()
    assert {tuple(r) for r in got} == {(h, "a" if h % 2 else "b", 4) for h in range(5)} and len(feed.versions(spark, f"{root}/table")) == 2
