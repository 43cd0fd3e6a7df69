"""Sources, sinks and curation over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.functions import text as T
from corpusloom.operators import upsert
from corpusloom.plans.registry import Registry
from corpusloom.session import materialise, shared_dir, table
from corpusloom.sources import readers, sinks
from corpusloom.streaming import feed

R = Registry()


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/corpusloom/{uuid.uuid4().hex}"


@R.add("""select row_id, coalesce(id, '') as id, coalesce(replace(replace(text, chr(13), ' '), chr(10), ' '), '') as text from posts""")
def s01_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All posts through CSV with padded header names and unquoted commas in the last field (texts that hold quotes are quoted)."""
    path = _folder(spark)
    flat = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]", " ")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    last = F.when(F.contains(flat, F.lit('"')), quoted(flat)).otherwise(flat)
    lines = table(spark, sf, "posts").select(F.concat_ws(",", F.col("row_id").cast("string"), quoted(F.coalesce("id", F.lit(""))), last).alias("value"))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([" row_id,id , text "])], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("value")], ["value"])

    lines.mapInArrow(headed, "value string").write.text(path)
    return readers.csv_rows(spark, path).select(F.col("row_id").cast("long").alias("row_id"), "id", "text")


@R.add("""select c_custkey as k, c_name as name, c_mktsegment as segment from customer""")
def s02_json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All customers through JSON documents that wrap a list of records, one document a nation."""
    path = _folder(spark)
    c = table(spark, sf, "customer").select("c_nationkey", F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("r"))
    docs = c.groupBy("c_nationkey", F.pmod("r.k", F.lit(50)).alias("part")).agg(F.collect_list("r").alias("data"))
    docs.select(F.to_json(F.struct("data")).alias("value")).repartition(8).write.text(path)
    lines = spark.read.text(path)
    v = F.try_variant_get(F.try_parse_json("value"), "$.data", "array<struct<k bigint, name string, segment string>>")
    return lines.select(F.explode(v).alias("r")).select("r.*")


@R.add("""select n_nationkey::varchar as key, n_name as name from nation""")
def s03_header_first(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON array of arrays whose first row names the columns."""
    n = table(spark, sf, "nation").agg(F.array_sort(F.collect_list(F.array("n_name", F.col("n_nationkey").cast("string")))).alias("rows"))
    doc = n.select(F.to_json(F.concat(F.array(F.array(F.lit("name"), F.lit("key"))), "rows")).alias("doc"))
    return readers.header_first_array(doc, "doc", ["key", "name"])


@R.add(r"""
select row_id, coalesce(nullif(trim(regexp_replace(title, '[ \t\n\r\f\v]+', ' ', 'g'), ' '), ''), 'Untitled') as title, coalesce(event_date, '') as date, md5(trim(regexp_replace(regexp_replace(text, '[<>&"\\]', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ')) as body from speeches where text is not null and trim(regexp_replace(regexp_replace(text, '[<>&"\\]', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ') <> ''""")
def s06_html_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Speeches as pages and back: heading, date and body by priority of selectors."""
    plain = T.collapse(F.regexp_replace("text", r'[<>&"\\]', " "))
    page = F.concat(F.lit("<html><head><title>Untitled</title></head><body><h1>"), F.coalesce("title", F.lit("")), F.lit('</h1><time datetime="'), F.coalesce("event_date", F.lit("")), F.lit('"></time><article><p>'), plain, F.lit("</p></article></body></html>"))
    s = table(spark, sf, "speeches").filter(F.col("text").isNotNull() & (plain != "")).select("row_id", page.alias("html"))
    parts = readers.html_article(F.col("html"))
    return s.select("row_id", parts["title"].alias("title"), F.coalesce(parts["date"], F.lit("")).alias("date"), F.md5(parts["body"]).alias("body"))


@R.add(r"""
select row_id, 1::bigint as no, coalesce(trim(regexp_replace(title, '[\r\n]', ' ', 'g'), ' '), '') as title, length(regexp_replace(text, '[ \t\r\n]', '', 'g')) as body_len from speeches where regexp_replace(text, '[ \t\r\n]', '', 'g') <> ''""")
def s07_delimited_text(spark: SparkSession, sf: str) -> DataFrame:
    """Delimited records: what stands before the first marker is dropped."""
    raw = F.concat(F.lit("preface\nSPEECH "), F.coalesce(F.regexp_replace("title", r"[\r\n]", " "), F.lit("")), F.lit("\n"), F.col("text"), F.lit("\nspeech empty\n\n"))
    s = table(spark, sf, "speeches").filter("text is not null").select("row_id", raw.alias("raw"))
    out = readers.delimited_speeches(s, "raw")
    return out.select("row_id", F.col("no").cast("long").alias("no"), "title", F.length(F.regexp_replace("body", r"[ \t\r\n]", "")).cast("long").alias("body_len")).filter("body_len > 0")


@R.add(r"""
with u as (select row_id, unnest(regexp_extract_all(text, 'https?://[^ \t\n\r\f\v"''<>]+')) as url from posts)
select url, min(row_id) as row_id from u group by 1""")
def s08_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every linked URL with the first row that has it."""
    p = table(spark, sf, "posts").select("row_id", F.explode(readers.links(F.col("text"))).alias("url"))
    return p.groupBy("url").agg(F.min("row_id").alias("row_id"))


@R.add("""select n_name as city, n_nationkey::varchar as date from nation""")
def s09_html_table(spark: SparkSession, sf: str) -> DataFrame:
    """A page's table, its columns located by parts of the header cells."""
    row = F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td><b>"), "n_name", F.lit("</b></td></tr>"))
    page = table(spark, sf, "nation").agg(F.concat(F.lit("<table><tr><th>Event date</th><th>City / venue</th></tr>"), F.array_join(F.sort_array(F.collect_list(row)), ""), F.lit("</table>")).alias("html"))
    return readers.html_table(page, "html", {"date": "date", "city": "city"})


@R.add("""
select d.doc_id, coalesce(a.name, b.name) as name from documents d left join sources a on a.source_id = d.source and a.notes is not null left join sources b on b.source_id = d.source""")
def s10_two_stage_lookup(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources").select(F.col("source_id").alias("k"), "name", "notes")
    got = readers.two_stage_lookup(table(spark, sf, "documents"), F.col("source"), s.filter("notes is not null"), s, "name")
    return got.select("doc_id", "name")


@R.add("""
select account, row_id from (select account, row_id, row_number() over (partition by account order by row_id) as k from posts where regexp_matches(lower(concat_ws(' ', source_url, media_urls_json)), 'mp4|jpg')) where k = 1""")
def s11_first_match(spark: SparkSession, sf: str) -> DataFrame:
    """Per account the first row that holds any of the tokens."""
    p = table(spark, sf, "posts").filter(F.lower(F.concat_ws(" ", "source_url", "media_urls_json")).rlike("mp4|jpg"))
    return upsert.keep_first(p.select("account", "row_id"), ["account"], [F.col("row_id")])


@R.add("""select count(*) as n, sum(l_linenumber)::bigint as lines, round(sum(l_quantity), 2) as quantity from lineitem where l_shipdate >= timestamp '1997-01-01'""")
def s12_pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return q.agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@R.add("""
with e as (select event_id, value, unnest(generate_series(0, ceil(value / 12)::int - 1)) as piece from events where value > 0)
select event_id, piece, round(piece * 12.0::double, 4) as a, round(least(value, (piece + 1) * 12.0::double), 4) as b from e where least(value, (piece + 1) * 12.0::double) - piece * 12.0::double >= 2""")
def s13_split_intervals(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.lit(0.0).alias("start"), F.col("value").alias("stop"))
    got = readers.split_intervals(e, "start", "stop", 12.0, 2.0)
    return got.select("event_id", F.col("piece").cast("long").alias("piece"), F.round("piece_start", 4).alias("a"), F.round("piece_end", 4).alias("b"))


@R.add("""
select source_id, coalesce(notes, '') as notes, record_count from sources union all values ('gap_source', 'no records found', 0)""")
def s14_gap_row(spark: SparkSession, sf: str) -> DataFrame:
    """A source without records leaves a row in the ledger."""
    gap = spark.createDataFrame([("gap_source", "no records found", 0)], "source_id string, notes string, record_count long")
    return table(spark, sf, "sources").select("source_id", F.coalesce("notes", F.lit("")).alias("notes"), "record_count").unionByName(gap)


@R.add("""select true as here, false as missing""")
def s15_table_exists(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "region").createOrReplaceTempView("corpusloom_region")
    got = (readers.table_exists(spark, "corpusloom_region"), readers.table_exists(spark, "corpusloom_none"))
    return spark.createDataFrame([got], "here boolean, missing boolean")


# ---------------------------------------------------------------- sinks


@R.add("""
with f as (select distinct on (id) id, account, text, is_repost, reply_to, row_id from posts where file_no = 0 order by id, row_id),
g as (select distinct on (id) id, account, text, is_repost, reply_to, row_id from posts where file_no > 0 order by id, row_id)
select coalesce(f.id, g.id) as id, case when g.id is not null then g.account else f.account end as account, coalesce(f.text, g.text) as text,
  case when g.id is not null then g.is_repost else f.is_repost end as is_repost, case when f.id is not null then f.reply_to else g.reply_to end as reply_to, coalesce(f.row_id, g.row_id) as row_id
from f full join g on f.id = g.id""")
def k01_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Later files merged into the first: some columns are updated, some kept, some only filled."""
    p = table(spark, sf, "posts").select("id", "account", "text", "is_repost", "reply_to", "row_id", "file_no")
    first = lambda d: upsert.keep_first(d, ["id"], [F.col("row_id")]).drop("file_no")
    return upsert.upsert(first(p.filter("file_no = 0")), first(p.filter("file_no > 0")), ["id"], ["account", "is_repost"], ["text"])


@R.add("""select feed as source_id, count(*) as record_count, count(distinct id) as stored_count from posts group by 1""")
def k02_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.ledger(table(spark, sf, "posts"), "feed", "id")


@R.add("""select id, min(row_id) as ignored, max(row_id) as replaced from posts group by 1""")
def k03_ignore_replace(spark: SparkSession, sf: str) -> DataFrame:
    """First row of each key (ignore later ones) and last row (replace earlier ones)."""
    p = table(spark, sf, "posts").select("id", "row_id")
    a = upsert.keep_first(p, ["id"], [F.col("row_id")]).withColumnRenamed("row_id", "ignored")
    b = upsert.keep_first(p, ["id"], [F.desc("row_id")]).withColumnRenamed("row_id", "replaced")
    return a.join(b, "id")


@R.add("""select o_orderkey, year(o_orderdate) as year, o_totalprice from orders""")
def k04_full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice in full and read again, partitioned by year."""
    path = _folder(spark)
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    for _ in range(2):
        sinks.refresh(o, path, ["year"])
    return spark.read.parquet(path).select("o_orderkey", "year", "o_totalprice")


@R.add("""select slug, label, description, color, anchor_count from theme_catalog""")
def k05_parquet_export(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(table(spark, sf, "theme_catalog")).select("slug", "label", "description", "color", "anchor_count")


@R.add("""select '{"user_id":' || user_id || ',"n":' || count(*) || '}' as payload from events group by user_id""")
def k06_json_payload(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return sinks.payload(n, ["user_id", "n"])


@R.add("""select vec_id, len(embedding)::int as dim, round(list_sum(list_transform(embedding, lambda x: x::double)), 5) as total from embeddings""")
def k07_vectors(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    sinks.vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", path)
    v = spark.read.parquet(path)
    return v.select("vec_id", F.size("embedding").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"))


@R.add("""select coalesce(id, '') || '|' || coalesce(replace(title, '|', ' '), '') || '|' || coalesce(replace(location, '|', ' '), '') as line from speeches""")
def k08_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.manifest(table(spark, sf, "speeches"), ["id", "title", "location"])


@R.add("""
select 'posts' as section, platform as name, count(*) as n from posts group by 2 union all select 'speeches', coalesce(event_type, 'none'), count(*) from speeches group by 2 union all select 'documents', kind, count(*) from documents group by 2""")
def k10_summary(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda t, c: table(spark, sf, t).groupBy(F.coalesce(c, F.lit("none")).alias("name")).agg(F.count("*").alias("n")).select(F.lit(t).alias("section"), "name", "n")
    return part("posts", "platform").unionByName(part("speeches", "event_type")).unionByName(part("documents", "kind"))


@R.add("""select '{' || string_agg('"' || r_name || '":' || r_regionkey, ',' order by r_name) || '}' as payload from region""")
def k11_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.dictionary(table(spark, sf, "region"), "r_name", F.col("r_regionkey"))


@R.add("""select row_id, sha256(text) as sha256 from speeches where text is not null""")
def k12_sha256(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "speeches").filter("text is not null").select("row_id", F.sha2("text", 256).alias("sha256"))


@R.add("""
select id, bool_or(file_no = 0) as was_done from posts group by 1""")
def k13_incremental_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the first file stand; of the later ones only the new ids are added."""
    p = table(spark, sf, "posts").select("id", "file_no")
    done = p.filter("file_no = 0").select("id").distinct()
    new = upsert.not_done(p.filter("file_no > 0").select("id").distinct(), done, "id")
    return done.withColumn("was_done", F.lit(True)).unionByName(new.withColumn("was_done", F.lit(False)))


@R.add("""select '{"name":"' || name || '","url":"' || url || '"}' as payload from sources where name is not null and url is not null""")
def k14_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.payload(table(spark, sf, "sources").filter("name is not null and url is not null"), ["name", "url"])


@R.add("""select id, min(account) as account from posts group by 1""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The posts as a stream of landed files, merged by key as they arrive."""
    root = _folder(spark)
    p = table(spark, sf, "posts").groupBy("id", "file_no").agg(F.min("account").alias("account"))
    p.write.parquet(f"{root}/landed")
    feed.stream_upsert(spark, f"{root}/landed", "id string, file_no int, account string", f"{root}/table", ["id"], [F.col("account")], [], f"{root}/offsets")
    return feed.latest(spark, f"{root}/table").groupBy("id").agg(F.min("account").alias("account"))


@R.add("""
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as start, event_type, count(*) as n from events group by 1, 2""")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return feed.windowed_counts(e, "ts", "event_type").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


# ---------------------------------------------------------------- curation


@R.add("""
select case when title is null then 'title' when event_date is null or event_date = '' then 'date' when event_type is null then 'type' else 'good' end as reason, count(*) as n from speeches group by 1""")
def u13_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that break a rule go to a table of rejects with the first rule they break."""
    rules = {"title": F.col("title").isNotNull(), "date": F.col("event_date").isNotNull() & (F.col("event_date") != ""), "type": F.col("event_type").isNotNull()}
    good, bad = upsert.quarantine(table(spark, sf, "speeches"), rules)
    both = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    return both.groupBy("reason").agg(F.count("*").alias("n"))


@R.add("""
with t as (select account, row_id, length(text) as dur from posts where text is not null),
b as (select *, coalesce(sum(dur) over (partition by account order by dur desc, row_id rows between unbounded preceding and 1 preceding), 0) as before from t)
select account, count(*) as n, sum(dur)::bigint as total from b where before < 2000 group by 1""")
def u05_curated_total(spark: SparkSession, sf: str) -> DataFrame:
    """The longest texts of each account up to a total."""
    t = table(spark, sf, "posts").filter("text is not null").select("account", "row_id", F.length("text").alias("dur"))
    cut = stats.running_cutoff(t, ["account"], [F.desc("dur"), F.col("row_id")], "dur", 2000.0)
    return cut.groupBy("account").agg(F.count("*").alias("n"), F.sum("dur").alias("total"))


@R.add("""
select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice), 2) as sum_base, round(sum(l_extendedprice * (1 - l_discount)), 4) as sum_disc, round(avg(l_discount), 6) as avg_disc, count(*) as n from lineitem group by 1, 2""")
def bench_pricing(spark: SparkSession, sf: str) -> DataFrame:
    """Volume: one pass over the largest table."""
    q = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return q.agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sum_disc"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@R.add("""
select s_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) as revenue, count(distinct l_orderkey) as orders from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2""")
def bench_supplier_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregated by the join key before the join, so the shuffle carries one row a supplier and order."""
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"), F.countDistinct("l_orderkey").alias("orders"))
    j = per.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select("s_name", "n_name", F.round("r", 4).alias("revenue"), "orders")


@R.add("""
select o_orderpriority, o_orderkey, r from (select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as r from orders) where r <= 10""")
def bench_top_orders(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", F.row_number().over(w).alias("r")).filter("r <= 10")


QUERIES, SQL = R.queries, R.sql
