from datetime import datetime, timedelta, timezone

import pytest

from corpusloom.operators import instants as I

NY = "America/New_York"
CASES = [
    ("2020-10-18T19:08Z", None, "2020-10-18 19:08:00"), ("2009-04-23T22:54:49.412371+00:00", NY, "2009-04-23 22:54:49.412371"),
    ("2012-03-04 05:06:07,125", None, "2012-03-04 05:06:07.125"), ("20090204170938", NY, "2009-02-04 22:09:38"), ("1241903712", None, "2009-05-09 21:15:12"),
    ("1239102366020", NY, "2009-04-07 11:06:06.020"), ("123", NY, "1970-01-01 00:02:03"), ("2009", NY, None), ("01/13/2011 3:56 AM", NY, "2011-01-13 08:56:00"),
    ("13/01/2011 3:56 AM", None, None), ("03/04/2016 12:05 AM", NY, "2016-03-04 05:05:00"), ("03/04/2016 12:05 PM", None, "2016-03-04 12:05:00"), ("03/04/2016 13:05 PM", None, None),
    ("01.12.2013 13:20", NY, "2013-12-01 18:20:00"), ("01.13.2013 13:20", NY, None), ("Fri Apr 01 22:24:03 +0000 2011", NY, "2011-04-01 22:24:03"),
    ("Fri, 01 May 2009 07:31:09 -0400", None, "2009-05-01 11:31:09"), ("Sat, 99 Foo 2017 25:61:00 GMT", None, None), ("Apr 17, 2017 · 9:39 AM UTC", NY, "2017-04-17 09:39:00"),
    ("April 11, 2023 5:20 a.m.", NY, "2023-04-11 09:20:00"), ("10 Jun 2011", NY, "2011-06-10 04:00:00"), ("April 2009", NY, None), ("2009-03", None, None),
    ("2010-07-20 10:55:27 EST", NY, "2010-07-20 15:55:27"), ("2016-03-09 10:00 CEST", NY, "2016-03-09 08:00:00"), ("2013-11-03 01:38:30 America/New_York", None, "2013-11-03 05:38:30"),
    ("2019-03-10 02:30:00", NY, "2019-03-10 07:30:00"), ("2021-02-30 10:00:00", None, None), ("0000-00-00 00:00:00", NY, None), (" \t2010-03-14T02:01:07+00:00 ", None, "2010-03-14 02:01:07"),
    ("2009-02-28 14:38:01+05:45", NY, "2009-02-28 08:53:01"), ("2010-01-22T07:40:00-0330", None, "2010-01-22 11:10:00"), ("2010-01-22 07:40:00 Nowhere/Bad", None, None),
    ("2010-01-22 07:40:00", "Not/AZone", "2010-01-22 07:40:00"), ("pending", NY, None), ("", None, None), (None, NY, None), ("x" * 100_000, None, None), ("2010-10-18 24:00:00", None, None), ("2010-10-18 23:59:60", None, None),
]


def us(text):
    t = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def test_writings(spark):
    df = spark.createDataFrame([(i, v, z, "s", "clash", 1) for i, (v, z, _) in enumerate(CASES)], "row_id int, value string, tz string, source string, year string, writing int")
    got = {r.row_id: r for r in I.resolve(df, "value", "tz", "source", I.STATED).collect()}
    assert len(got) == len(CASES)
    for i, (v, z, want) in enumerate(CASES):
        assert got[i].utc_us == (us(want) if want else None), (v, z)
        assert (got[i].status in ("resolved", "ambiguous_fold", "skipped")) == bool(want)
    by = {v: got[i].status for i, (v, _, _) in enumerate(CASES)}
    assert by["2013-11-03 01:38:30 America/New_York"] == "ambiguous_fold" and by["2019-03-10 02:30:00"] == "skipped"
    assert [v for v, x in by.items() if x in ("ambiguous_fold", "skipped")] == ["2013-11-03 01:38:30 America/New_York", "2019-03-10 02:30:00"]


def test_em_learns_the_reading_of_each_source(spark):
    rows = [("eu", f"{d:02d}/03/2020") for d in range(13, 29)] + [("us", f"03/{d:02d}/2020") for d in range(13, 29)] + [(s, "05/06/2020") for s in ("eu", "us", "none")] * 2 + [(None, "05/06/2020"), ("eu", "44/44/2020")]
    df = spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(rows)], "row_id int, source string, value string")
    got = [r for r in I.resolve(df, "value", None, "source").collect() if r.value == "05/06/2020"]
    by = {(r.source, r.utc_us, r.status) for r in got}
    assert by == {("eu", us("2020-06-05"), "resolved"), ("us", us("2020-05-06"), "resolved"), ("none", None, "unresolved"), (None, None, "unresolved")}
    assert len(got) == 7


def test_empty(spark):
    df = spark.createDataFrame([], "value string, source string")
    assert I.resolve(df, "value", None, "source").count() == 0


def test_sources_without_evidence_follow_the_others(spark):
    rows = [("a", f"{m:02d}/{d:02d}/2020") for m in range(1, 13) for d in range(13, 25)] + [("b", "05/06/2020"), (None, "05/06/2020"), ("c", "1443785823"), ("c", "1365062109434"), ("c", "2016-01-01"), ("c", "2013-05-05"), ("d", "25/06/2020")]
    df = spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(rows)], "row_id int, source string, value string")
    got = {(r.source, r.value): (r.utc_us, r.status) for r in I.resolve(df, "value", None, "source").collect()}
    assert got["b", "05/06/2020"] == got[None, "05/06/2020"] == (us("2020-05-06"), "resolved")
    assert got["c", "1443785823"] == (1443785823 * 10**6, "resolved") and got["c", "1365062109434"] == (1365062109434 * 1000, "resolved")
    # A belief of 20 values holds against one value of the source, but not against many.
    firm = {(r.source, r.value): r.status for r in I.resolve(df, "value", None, "source", beliefs=I.STATED, strength=20.0).collect()}
    assert firm["d", "25/06/2020"] == "unresolved" and got["d", "25/06/2020"][0] == us("2020-06-25")


def test_folds_and_gaps(spark):
    rows = [("2021-11-07 01:30:00", NY), ("2021-11-07 02:00:00", NY), ("2021-11-07 00:59:59", NY), ("2021-03-14 02:00:00", NY), ("2021-03-14 03:00:00", NY), ("2021-04-04 01:45:00", "Australia/Lord_Howe"), ("2021-04-04 01:15:00", "Australia/Lord_Howe"), ("2021-11-07 01:30:00", "UTC"), ("2021-11-07 01:30:00 EST", NY)]
    df = spark.createDataFrame([(v, z, "s") for v, z in rows], "value string, tz string, source string")
    got = {(r.value, r.tz): r.status for r in I.resolve(df, "value", "tz", "source").collect()}
    marks = ["ambiguous_fold", "resolved", "resolved", "skipped", "resolved", "ambiguous_fold", "resolved", "resolved", "resolved"]
    assert got == dict(zip(rows, marks, strict=True))


def test_fit_keeps_conventions():
    pd = pytest.importorskip("pandas")
    counts = pd.DataFrame({"writing": ["slashed"] * 2, "mask": [3, 2], "decade_0": [-1, -1], "decade_1": [-1, -1], "n": [5, 100]})
    got = I.fit(counts, {"slashed": [1.0, 0.0]}, {-1: 0.1}).set_index("mask")
    assert got.loc[3, "reading"] == "mdy" and got.loc[2, "reading"] is None
