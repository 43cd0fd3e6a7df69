"""Further sources, sinks, joins and labels over the driver's tables, through files where that is the point."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import stats, timeparts
from corpusloom.operators import places, rules, upsert, vectors
from corpusloom.plans.analytics import _CSQL
from corpusloom.plans.registry import Registry
from corpusloom.session import shared_dir, table
from corpusloom.sources import readers, sinks
from corpusloom.streaming import feed

R = Registry()


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/corpusloom/{uuid.uuid4().hex}"


# ---------------------------------------------------------------- upserts


_SPLIT = """f as (select distinct on (id) * from posts where file_no = 0 order by id, row_id), g as (select distinct on (id) * from posts where file_no > 0 order by id, row_id)"""


@R.add(f"""
with {_SPLIT}
select coalesce(f.id, g.id) as id, coalesce(g.account, f.account) as account, case when f.id is not null then coalesce(f.timestamp_utc, g.timestamp_utc) else g.timestamp_utc end as timestamp_utc,
  case when f.id is not null then f.metrics_json else g.metrics_json end as metrics_json from f full join g on f.id = g.id""")
def k01_overwrite_account(spark: SparkSession, sf: str) -> DataFrame:
    """A source whose account overwrites and whose timestamp gives way to the one that is there."""
    p = table(spark, sf, "posts").select("id", "account", "timestamp_utc", "metrics_json", "row_id", "file_no")
    first = lambda d: upsert.keep_first(d, ["id"], [F.col("row_id")]).drop("file_no", "row_id")
    return upsert.upsert(first(p.filter("file_no = 0")), first(p.filter("file_no > 0")), ["id"], ["account"], ["timestamp_utc"])


@R.add(f"""
with {_SPLIT}
select coalesce(f.id, g.id) as id, case when g.id is not null then g.is_repost else f.is_repost end as is_repost, case when g.id is not null then g.media_urls_json else f.media_urls_json end as media_urls_json,
  case when g.id is not null then g.metrics_json else f.metrics_json end as metrics_json, case when f.id is not null then f.reply_to else g.reply_to end as reply_to from f full join g on f.id = g.id""")
def k01_flags_and_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A source that updates flags, media and metrics, but not the post replied to."""
    p = table(spark, sf, "posts").select("id", "is_repost", "media_urls_json", "metrics_json", "reply_to", "row_id", "file_no")
    first = lambda d: upsert.keep_first(d, ["id"], [F.col("row_id")]).drop("file_no", "row_id")
    return upsert.upsert(first(p.filter("file_no = 0")), first(p.filter("file_no > 0")), ["id"], ["is_repost", "media_urls_json", "metrics_json"])


@R.add("""
with p as (select id, account, text, least(file_no, 3) as land from posts where text is not null),
l as (select id, land, min(account) as account, min(text) as text from p group by 1, 2)
select id, arg_max(account, land) as account, arg_min(text, land) as text, count(*) as landings from l group by 1""")
def stream_upsert_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Four landings in several micro-batches: accounts are updated, texts kept, landings counted; old versions are removed."""
    root = _folder(spark)
    p = table(spark, sf, "posts").filter("text is not null").select("id", "account", "text", F.least("file_no", F.lit(3)).alias("land")).groupBy("id", "land").agg(F.min("account").alias("account"), F.min("text").alias("text"))
    for k in range(4):
        # One landing after the other, as the stream reads files in the order of their times.
        p.filter(F.col("land") == k).withColumn("landings", F.lit(1).cast("long")).select("id", "account", "text", "landings", "land").write.mode("append").parquet(f"{root}/landed")
    schema = "id string, account string, text string, landings long, land int"
    feed.stream_upsert(spark, f"{root}/landed", schema, f"{root}/table", ["id"], [F.desc("land")], ["account", "land"], f"{root}/offsets", keep=["text"], add=["landings"], files_per_batch=4)
    if len(feed.versions(spark, f"{root}/table")) > 2:
        raise AssertionError("old versions are left")
    return feed.latest(spark, f"{root}/table").select("id", "account", "text", "landings")


@R.add("""select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as start, event_type, count(*) as n from events group by 1, 2""")
def stream_windows_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts of a stream of landed files in several micro-batches; as files come in any order, windows stay open for the month."""
    root = _folder(spark)
    e = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    e.repartition(6).write.parquet(f"{root}/landed")
    feed.stream_windows(spark, f"{root}/landed", "ts timestamp, event_type string", "ts", "event_type", f"{root}/table", f"{root}/offsets", late="40 days", files_per_batch=2)
    return feed.latest(spark, f"{root}/table").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


# ---------------------------------------------------------------- files


_EXPORTED = ("posts", "speeches", "sources", "theme_catalog", "post_themes", "documents")


@R.add(" union all ".join(f"select '{t}' as name, count(*) as n_rows, (select count(*) from (describe {t})) as n_columns from {t}" for t in _EXPORTED))
def k05_export_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Each table exported to a folder of its own, then read: rows and columns."""
    path, parts = _folder(spark), []
    for t in _EXPORTED:
        table(spark, sf, t).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{t}")
        back = spark.read.parquet(f"{path}/{t}")
        parts.append(back.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("name"), "n_rows", F.lit(len(back.columns)).cast("long").alias("n_columns")))
    return functools.reduce(DataFrame.unionByName, parts)


@R.add("""select c_custkey as k, c_name as name, c_mktsegment as segment from customer""")
def s02_json_files(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through JSON files whose documents are a list or wrap one, by region of the customer."""
    path = _folder(spark)
    record = F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    c = table(spark, sf, "customer").select("c_nationkey", F.pmod(F.hash("c_custkey"), F.lit(4)).alias("part"), record.alias("r"))
    docs = c.groupBy("c_nationkey", "part").agg(F.to_json(F.collect_list("r")).alias("list"))
    shape = F.pmod("c_nationkey", F.lit(4))
    doc = F.when(shape == 0, F.col("list")).otherwise(F.concat(F.lit('{"'), F.when(shape == 1, "data").when(shape == 2, "posts").otherwise("records"), F.lit('": '), F.col("list"), F.lit(', "page": 1}')))
    docs.select("c_nationkey", "part", doc.alias("value")).write.partitionBy("c_nationkey", "part").text(path)
    return readers.json_records(spark, path, "struct<k: bigint, name: string, segment: string>")


@R.add("""select source_id, strlen(name)::bigint + 1 as size, sha256(name || chr(10)) as sha256 from sources where name is not null""")
def k12_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Size and digest of files as they lie on disk."""
    path = _folder(spark)
    table(spark, sf, "sources").filter("name is not null").select("source_id", F.col("name").alias("value")).write.partitionBy("source_id").text(path)
    got = readers.artifacts(spark, f"{path}/*")
    return got.select(F.regexp_extract("path", "source_id=([^/]+)/", 1).alias("source_id"), "size", "sha256")


@R.add("""select doc_id, source from documents where source in (select source_id from sources where notes is not null and name is not null)""")
def j16_listed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the sources for which a file lies in a folder."""
    path = _folder(spark)
    table(spark, sf, "sources").filter("name is not null and notes is not null").select("source_id", F.col("notes").alias("value")).write.partitionBy("source_id").text(path)
    listing = readers.artifacts(spark, f"{path}/*").select(F.regexp_extract("path", "source_id=([^/]+)/", 1).alias("source")).distinct()
    return table(spark, sf, "documents").select("doc_id", "source").join(listing, "source", "left_semi").select("doc_id", "source")


@R.add("""
with f as (select id, min(row_id) as row_id, 0 as run from posts where file_no = 0 group by 1), g as (select id, min(row_id) as row_id, 1 as run from posts where file_no > 0 group by 1)
select * from f union all select * from g where id not in (select id from f)""")
def k13_manifest_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over one stored manifest: entries that are there stand, new ones are added."""
    path = _folder(spark)
    entries = lambda c, run: table(spark, sf, "posts").filter(c).groupBy("id").agg(F.min("row_id").alias("row_id")).withColumn("run", F.lit(run))
    sinks.merge_manifest(spark, path, entries("file_no = 0", 0), "id")
    sinks.merge_manifest(spark, path, entries("file_no > 0", 1), "id")
    return spark.read.parquet(path)


@R.add("""select '{"sources":{"' || source_id || '":{"title":"' || name || '","credit":{"url":"' || url || '","records":' || coalesce(record_count::varchar, 'null') || '}}}}' as payload from sources where name is not null and url is not null""")
def k14_nested_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """Nested attribution written to JSON files and read again."""
    path = _folder(spark)
    s = table(spark, sf, "sources").filter("name is not null and url is not null")
    credit = F.struct(F.col("url"), F.col("record_count").alias("records"))
    nested = F.struct(F.create_map(F.col("source_id"), F.struct(F.col("name").alias("title"), credit.alias("credit"))).alias("sources"))
    s.select(F.to_json(nested, {"ignoreNullFields": "false"}).alias("value")).write.text(path)
    return spark.read.text(path).select(F.col("value").alias("payload"))


@R.add(r"""
select source_url, row_id, length(text) as n_chars from (select source_url, row_id, text, row_number() over (partition by source_url order by row_id) as k from speeches where source_url is not null) where k = 1 and length(text) >= 200""")
def s08_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of each link, if its text is long enough for a transcript."""
    s = table(spark, sf, "speeches").filter("source_url is not null").select("source_url", "row_id", "text")
    return upsert.keep_first(s, ["source_url"], [F.col("row_id")]).filter(F.length("text") >= 200).select("source_url", "row_id", F.length("text").cast("long").alias("n_chars"))


@R.add("""
select row_id, coalesce(case when length(location) > 0 then location end, regexp_extract(coalesce(title, ''), ' in ([A-Z][a-z]+)', 1)) as place,
  '2020-' || lpad((1 + row_id % 12)::varchar, 2, '0') || '-05' as date from speeches""")
def s09_table_fallbacks(spark: SparkSession, sf: str) -> DataFrame:
    """A table whose date stands in its column or in any cell, and whose place in its column or in the text of the row."""
    months = F.lit(["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"])
    month = F.get(months, F.pmod("row_id", F.lit(12)).cast("int"))
    date = F.concat(month, F.lit(" 5, 2020"))
    text = _plain(F.coalesce("title", F.lit("")))
    cell = lambda *c: F.concat(F.lit("<td>"), *c, F.lit("</td>"))
    in_column = F.pmod("row_id", F.lit(2)) == 0
    row = F.concat(F.lit("<tr>"), cell(F.when(in_column, date).otherwise("n/a")), cell(_plain(F.coalesce("location", F.lit("")))), cell(text), cell(F.when(in_column, "-").otherwise(F.concat(F.lit("held on "), date))), F.lit("</tr>"))
    page = F.concat(F.lit("<table><tr><th>Date</th><th>Location</th><th>Title</th><th>Notes</th></tr>"), row, F.lit("</table>"))
    pages = table(spark, sf, "speeches").select("row_id", page.alias("html"))
    t = readers.html_table(pages, "html", {"date": "date", "place": "location"}, row="whole")
    found = readers.month_name_date(F.col("date"), F.col("whole"))
    return t.select("row_id", F.coalesce(F.nullif("place", F.lit("")), F.regexp_extract("whole", " in ([A-Z][a-z]+)", 1)).alias("place"), F.date_format(found, "yyyy-MM-dd").alias("date"))


def _plain(c: Column) -> Column:
    return F.regexp_replace(c, "[<>&|]", " ")


@R.add("""
with k as (select distinct source as k from documents where source is not null), c as (select source_id as k, name as v from sources where source_id < 'src3')
select k.k, case when c.k is not null then c.v else s.name end as name, c.k is not null as cached from k left join c on c.k = k.k left join sources s on s.source_id = k.k""")
def s10_cached_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A look-up with a stored cache: what it holds, names and negative entries, isn't looked up again."""
    path = _folder(spark)
    s = table(spark, sf, "sources").select(F.col("source_id").alias("k"), F.col("name").alias("v"))
    keys = table(spark, sf, "documents").filter("source is not null").select(F.col("source").alias("k")).distinct()
    s.filter("k < 'src3'").write.parquet(f"{path}/v=0")
    cache = spark.read.parquet(f"{path}/v=0")
    found, grown = readers.cached_lookup(keys, cache, s)
    grown.write.parquet(f"{path}/v=1")
    again, _ = readers.cached_lookup(keys, spark.read.parquet(f"{path}/v=1"), s.limit(0))
    return found.select("k", "cached").join(again.select("k", F.col("v").alias("name")), "k").select("k", "name", "cached")


# ---------------------------------------------------------------- joins, labels, rules


@R.add("""
with y as (select year(o_orderdate) as year, count(*) as n from orders group by 1), want as (select unnest([1990, 1992, 1996, 1999, 2005, 2006]) as target),
c as (select target, year, n, row_number() over (partition by target order by abs(year - target), year) as k from want join y on abs(year - target) <= 4)
select target::bigint as target, year::int as year, n from c where k = 1""")
def j14_within_four_years(spark: SparkSession, sf: str) -> DataFrame:
    """For each wanted year the nearest one with data, at most four years away, by an equality join on the years around it."""
    y = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    want = spark.createDataFrame([(t,) for t in (1990, 1992, 1996, 1999, 2005, 2006)], "target long").select("target", F.explode(F.sequence(F.lit(-4), F.lit(4))).alias("d"))
    near = want.withColumn("year", (F.col("target") + F.col("d")).cast("int")).join(y, "year")
    best = near.groupBy("target").agg(F.min_by(F.struct("year", "n"), F.struct(F.abs("d"), "year")).alias("b"))
    return best.select("target", "b.year", "b.n")


_F = """f as (select s.vec_id, s.label, score, s.label = e.label as forced from s join embeddings e using (vec_id)),
r as (select *, row_number() over (partition by vec_id order by {} score desc, label) as rank from f where score >= 0.25 or coalesce(forced, false)),
x as (select vec_id, label::varchar as label, score, rank::int as rank from r where rank <= 3 union all select vec_id, 'general', 0.0, 1 from v where vec_id not in (select vec_id from r where rank <= 3))"""


def _forced(spark: SparkSession, sf: str, guarantee: bool) -> DataFrame:
    e = table(spark, sf, "embeddings")
    scores = vectors.similarities(e, "vec_id", "embedding", vectors.centroids(e, "label", "embedding"))
    return vectors.assign_labels(scores, "vec_id", forced=e.select("vec_id", "label"), guarantee=guarantee).select("vec_id", "label", "score", "rank")


@R.add(f"with {_CSQL}, {_F.format('')} select vec_id, label, score, rank from x")
def theme_forced(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with those that a rule forces, which are admitted at any score and ranked by it."""
    return _forced(spark, sf, False)


@R.add(f"with {_CSQL}, {_F.format('coalesce(forced, false) desc,')} select vec_id, label, score, rank from x")
def theme_guaranteed(spark: SparkSession, sf: str) -> DataFrame:
    """As ``theme_forced``, but forced labels keep a place whatever the others score."""
    return _forced(spark, sf, True)


@R.add("""
with t as (select post_id, lower(trim(theme)) as theme, max(score) as score from post_themes where score is not null and not isnan(score) group by 1, 2),
o as (select a.theme, a.post_id, list(b.theme order by b.score desc, b.theme) as ls from t a join t b on a.post_id = b.post_id and a.theme <> b.theme group by 1, 2)
select t.theme, t.post_id, coalesce(array_to_string(o.ls[1:2], ','), '') as others from t left join o using (theme, post_id)""")
def t09_theme_page(spark: SparkSession, sf: str) -> DataFrame:
    """On the page of a theme: each post with the best two of its other themes."""
    t = table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy("post_id", F.lower(F.trim("theme")).alias("theme")).agg(F.max("score").alias("score"))
    all_ = t.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("d"), "theme"))).alias("ls"))
    each = all_.select("post_id", "ls", F.explode("ls").alias("e"))
    others = F.transform(F.filter("ls", lambda x: x["theme"] != F.col("e.theme")), lambda x: x["theme"])
    return each.select(F.col("e.theme").alias("theme"), "post_id", F.array_join(F.slice(others, 1, 2), ",").alias("others"))


#: (rule for Spark, the same without look-ahead for the SQL).
_UNICODE = [
    (rules.Rule("straße(?!n)", "street", "good"), "(straße)(?:[^n]|$)"), (rules.Rule("город(?!а|у)", "city", "good"), "(город)(?:[^ау]|$)"), (rules.Rule("^[A-ZÄÖÜ][a-zäöüß]+ [a-zäöüß]+", "opening", "good"), "(?m)(^[A-ZÄÖÜ][a-zäöüß]+ [a-zäöüß]+)"),
    (rules.Rule("être", "be", "good"), "(être)"), (rules.Rule("años?", "year", "bad"), "(años?)"), (rules.Rule("ÉTÉ", "summer", "good"), "(ÉTÉ)"), (rules.Rule("ąć|ść", "ending", "bad"), "(ąć|ść)"),
]
_UCASES = " union all ".join(f"select doc_id, {i} as o, '{r.target}' as target, '{r.polarity}' as polarity, regexp_extract(text, '(?i){q}', 1) as surface from documents" for i, (r, q) in enumerate(_UNICODE))


@R.add(f"select doc_id, target, polarity, min_by(surface, o) as surface from ({_UCASES}) where surface <> '' group by 1, 2, 3")
def n01_unicode_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules with look-ahead and line starts under Unicode case folding."""
    return rules.matches(table(spark, sf, "documents"), "doc_id", "text", [r for r, _ in _UNICODE], flags="(?iumd)").select("doc_id", "target", "polarity", "surface")


_CODES = {"OH": "Ohio", "TX": "Texas", "NY": "New York", "WA": "Washington", "IA": "Iowa", "NH": "New Hampshire", "NV": "Nevada", "GA": "Georgia", "MI": "Michigan"}
_STATES = ", ".join(f"('{c}', '{n}')" for c, n in _CODES.items())


@R.add(f"""
with st(code, name) as (values {_STATES}), s as (select row_id, coalesce(location, '') as l, coalesce(title, '') as t, (row_id % 12)::int as k from speeches),
x as (select row_id, l, case when st.code is null then '' when s.k % 2 = 0 then st.code else st.name end as w, st.code from s left join (select *, row_number() over (order by code) - 1 as i from st) st on st.i = s.k)
select row_id, case when regexp_full_match(l, '[A-Z][a-z]+') and code is not null then l || ', ' || code else '' end as place, case when code is null or not regexp_full_match(l, '[A-Z][a-z]+') then '' else code end as state from x""")
def e16_city_state(spark: SparkSession, sf: str) -> DataFrame:
    """City and state out of free text, the state by its code or its full name."""
    codes = sorted(_CODES)
    k = F.pmod("row_id", F.lit(12)).cast("int")
    code = F.get(F.lit(codes), k)
    state = F.when(k % 2 == 0, code).otherwise(F.get(F.lit([_CODES[c] for c in codes]), k))
    text = F.concat(F.lit("Rally at the hall; "), F.coalesce("location", F.lit("")), F.lit(", "), F.coalesce(state, F.lit("somewhere")), F.lit(" (evening)"))
    s = table(spark, sf, "speeches").select("row_id", places.city_state(text, _CODES).alias("p"))
    return s.select("row_id", F.coalesce(F.concat_ws(", ", "p.city", "p.state"), F.lit("")).alias("place"), F.coalesce("p.state", F.lit("")).alias("state"))


# ---------------------------------------------------------------- days and times


@R.add("""
with d as (select strftime(l, '%Y-%m-%d') as day, year(l) as year, count(*) as n from (select published_at at time zone 'America/New_York' as l from documents where published_at is not null) group by 1, 2),
z as (select day, n, (n - avg(n) over (partition by year)) / case when stddev_pop(n) over (partition by year) = 0 then 1 else stddev_pop(n) over (partition by year) end as z from d)
select day, n, round(z, 2) as z from z where z > 2""")
def w02_local_storm_days(spark: SparkSession, sf: str) -> DataFrame:
    """Local days with far more documents than the others of their year."""
    d = timeparts.with_local_time(table(spark, sf, "documents").filter("published_at is not null"), "published_at", "America/New_York")
    n = d.groupBy("day", "year").agg(F.count("*").alias("n"))
    return stats.zscore_within(n, "n", ["year"]).filter("z > 2").select("day", "n", F.round("z", 2).alias("z"))


@R.add("""
select row_id, coalesce(strftime(try_strptime(case when regexp_full_match(timestamp_utc, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') then timestamp_utc end, '%Y-%m-%d %H:%M:%S'), '%b %d, %Y  %H:%M'), substr(timestamp_utc, 1, 16)) as shown from posts""")
def e21_shown_or_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The time as shown, or the start of what is written where it is no plain time."""
    raw = F.col("timestamp_utc")
    plain = F.when(raw.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"), raw)
    return table(spark, sf, "posts").select("row_id", timeparts.shown(F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss")), raw).alias("shown"))


QUERIES, SQL = R.queries, R.sql
