import statistics
from datetime import datetime

from pyspark.sql import functions as F

from corpusloom.functions import stats, timeparts
from corpusloom.functions import text as T
from corpusloom.operators import ordered, rules, terms, upsert, vectors
from corpusloom.sources import readers, sinks
from corpusloom.streaming import feed


def test_exclusive_decile(spark):
    for n in (2, 4, 5, 9, 10, 11, 37):
        values = [(i * 7919 % 101) / 7 for i in range(n)]
        want = statistics.quantiles(values, n=10)[8]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = df.agg(stats.exclusive_decile(F.collect_list("v")).alias("d")).first().d
        by = stats.exclusive_decile_by(df.withColumn("g", F.lit("x")), ["g"], "v").first()
        assert abs(got - want) < 1e-9 and abs(by.decile - want) < 1e-9 and by.n == n and by.top == max(values)


def test_zscore_variance_zero(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 1), (2, 3)], "y int, n int")
    assert sorted(r.z for r in stats.zscore_within(df, "n", ["y"]).collect()) == [-1.0, 0.0, 0.0, 1.0]


def test_mode_ties(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z")], "g string, v string")
    assert {(r.g, r.mode) for r in stats.mode_by(df, ["g"], "v").collect()} == {("a", "x"), ("b", "z")}


def test_local_time_over_changes(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 7, 1),), (datetime(2024, 1, 1, 3, 0),), (None,)], "ts timestamp")
    got = timeparts.with_local_time(df, "ts", "America/New_York").orderBy("ts").collect()
    assert got[0].day is None and (got[1].year, got[1].dow, got[1].hour) == (2023, 6, 22) and (got[2].hour, got[2].day) == (3, "2024-03-10")


def test_text(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("A WORD here!! it's <b>x</b>",), ("one two three",)], "t string")
    got = df.select(T.bigrams(T.tokens(F.col("t"))).alias("b"), T.caps_share(F.col("t")).alias("c"), T.exclamation_density(F.col("t")).alias("e"), T.strip_html(F.col("t")).alias("h"), T.first_filled(F.col("t"), F.lit("z")).alias("f")).collect()
    assert got[0].b == [] and got[1].b == [] and got[4].b == ["one two", "two three"]
    assert got[3].h == "A WORD here!! it's x" and got[1].f == "z" and got[2].f == "z" and got[1].e == 0.0


def test_upsert(spark):
    t = spark.createDataFrame([("a", 1, "x", None), ("b", 2, "y", "k")], "id string, flag int, account string, note string")
    u = spark.createDataFrame([("b", 9, "new", "other"), ("c", 3, "z", "n"), ("a", None, "w", "filled")], "id string, flag int, account string, note string")
    got = {tuple(r) for r in upsert.upsert(t, u, ["id"], ["flag", "account"], ["note"]).collect()}
    assert got == {("a", None, "w", "filled"), ("b", 9, "new", "k"), ("c", 3, "z", "n")}
    assert upsert.upsert(t, u.limit(0), ["id"], ["flag"]).count() == 2


def test_anti_join_ignores_nulls(spark):
    todo, done = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("a",), (None,)], "id string")
    assert [r.id for r in upsert.not_done(todo, done, "id").collect()] == ["b"]


def test_quarantine(spark):
    df = spark.createDataFrame([("a", "x"), (None, None), ("b", None)], "id string, ts string")
    good, bad = upsert.quarantine(df, {"id": F.col("id").isNotNull(), "ts": F.col("ts").isNotNull()})
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["id", "ts"]


def test_rules(spark):
    cat = [rules.Rule(r"\bsad!\b", "s", "bad"), rules.Rule("foo ?bar", "f", "bad"), rules.Rule("bar", "f", "bad"), rules.Rule("democrat(?!.*great)", "d", "bad"), rules.Rule("caf[éÉ]", "c", "good")]
    df = spark.createDataFrame([(1, "Sad! is FooBar"), (2, "bar only"), (3, "democrat great"), (4, "Democrat\ngreat CAFÉ"), (5, None), (6, "")], "id int, text string")
    got = {(r.id, r.target, r.surface) for r in rules.matches(df, "id", "text", cat).collect()}
    assert got == {(1, "f", "FooBar"), (2, "f", "bar"), (4, "d", "Democrat"), (4, "c", "CAFÉ")}


def test_assign_labels(spark):
    s = spark.createDataFrame([(1, l, x) for l, x in zip("abcde", (0.9, 0.8, 0.7, 0.6, 0.1), strict=True)] + [(2, "a", 0.1), (2, "b", 0.2), (3, "a", 0.5), (3, "b", 0.5)], "id int, label string, score double")
    forced = spark.createDataFrame([(1, "e"), (2, "a")], "id int, label string")
    def got(**k):
        return {(r.id, r["rank"]): r.label for r in vectors.assign_labels(s, "id", **k).collect()}

    assert got() == {(1, 1): "a", (1, 2): "b", (1, 3): "c", (2, 1): "general", (3, 1): "a", (3, 2): "b"}
    assert got(forced=forced) == {(1, 1): "a", (1, 2): "b", (1, 3): "c", (2, 1): "a", (3, 1): "a", (3, 2): "b"}
    assert got(forced=forced, guarantee=True)[(1, 1)] == "e"


def test_ordered(spark):
    df = spark.createDataFrame([(i * 37 % 101, "g" if i % 3 else "h") for i in range(101)], "o int, g string")
    assert [r["rank"] for r in ordered.global_rank(df, [F.col("o")], parts=5).orderBy("o").collect()] == list(range(1, 102))
    last = {}
    for r in ordered.previous(df, "g", "o", "o", "p", parts=5).orderBy("o").collect():
        assert r.p == last.get(r.g)
        last[r.g] = r.o


def test_tfidf_by_hand(spark):
    import math

    df = spark.createDataFrame([("d1", 1, "apple banana"), ("d1", 2, "cherry apple"), ("d2", 1, "apple date"), ("d3", 1, "banana cherry")], "doc string, o int, t string")
    got = {(r.doc, r.term): (r.n, r.score) for r in terms.tfidf(df, "doc", "t", "o").collect()}
    # Bigrams run across rows of a document: "banana cherry" is in d1 and d3.
    w = {t: (1 + math.log(n)) * (math.log(4 / 3) + 1) for t, n in (("apple", 2), ("banana", 1), ("cherry", 1), ("banana cherry", 1))}
    length = math.sqrt(sum(x * x for x in w.values()))
    assert got[("d1", "apple")] == (2, round(w["apple"] / length, 6)) and ("d1", "banana cherry") in got and ("d2", "date") not in got


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(' ID ,Time, Text \n1,t1,"he said ""x"", y"\n2,,plain, with comma\n3,t3,"two\nlines"\n')
    got = sorted(tuple(r) for r in readers.csv_rows(spark, str(tmp_path / "a.csv")).collect())
    assert got == [("1", "t1", 'he said "x", y'), ("2", "", "plain, with comma"), ("3", "t3", "two\nlines")]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text('[{"id": 1},\n {"id": 2}]')
    (tmp_path / "j" / "2.json").write_text('{"posts": [{"id": 3}]}')
    assert sorted(r.id for r in readers.json_records(spark, str(tmp_path / "j"), "struct<id bigint>").collect()) == [1, 2, 3]
    page = spark.createDataFrame([('<html><head><meta property="og:description" content="desc"><title>T</title></head></html>',), ('<script type="application/ld+json">[{"description":"d","datePublished":"2020"}]</script><time datetime="x">',), ("",)], "h string")
    p = readers.html_article(F.col("h"))
    rows = page.select(p["body"].alias("b"), p["date"].alias("d"), p["title"].alias("t")).collect()
    assert (rows[0].b, rows[0].t) == ("desc", "T") and (rows[1].b, rows[1].d) == ("d", "2020") and rows[2].b is None
    t = spark.createDataFrame([(1, "junk\nSPEECH one\nbody\nspeech two\n\n SPEECH three\nx y\n")], "k int, t string")
    assert [(r.title, r.body) for r in readers.delimited_speeches(t, "t").orderBy("no").collect()] == [("one", "body"), ("three", "x y")]
    assert len(readers.artifacts(spark, str(tmp_path / "a.csv")).first().sha256) == 64


def test_csv_overflow_is_whole(spark, tmp_path):
    many = ",".join(str(i) for i in range(30_000))
    texts = ["a, b", ",".join("abcdefghijkl"), many, ",,", "", 'x,"two\nlines, and"" more",,,,,,,,,z']
    rows = [(str(i), texts[i % len(texts)] if i < 12 else "plain") for i in range(400_000)]
    (tmp_path / "a.csv").write_text(" ID , Text \n" + "".join(f"{i},{t}\n" for i, t in rows) + "short\n")
    got = {r.ID: r.Text for r in readers.csv_rows(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {i: 'x,two\nlines, and" more,,,,,,,,,z' if '"' in t else t for i, t in rows} | {"short": ""}


def test_class_items_has_no_limit(spark):
    df = spark.range(1).select(F.repeat(F.lit('<p class="i">'), 1_000_010).alias("html"))
    assert readers.class_items(df, "html", "i", {}).count() == 1_000_010


def test_manifest(spark):
    df = spark.createDataFrame([("a|b", None), ("c", 1)], "x string, y int")
    assert [r.line for r in sinks.manifest(df, ["x", "y"]).collect()] == ["a b|", "c|1"]


def test_stream_upsert_resumes(spark, tmp_path):
    p = {k: str(tmp_path / k) for k in ("in", "table", "offsets")}
    schema = "id string, v int"
    for rows in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(p["in"])
        feed.stream_upsert(spark, p["in"], schema, p["table"], ["id"], [F.col("v")], ["v"], p["offsets"])
    assert {(r.id, r.v) for r in feed.latest(spark, p["table"]).collect()} == {("a", 1), ("b", 3), ("c", 4)}
