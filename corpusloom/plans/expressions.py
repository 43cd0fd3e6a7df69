"""Projections, predicates and scalar expressions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import timeparts
from corpusloom.plans.registry import Registry
from corpusloom.session import table

R = Registry()


@R.add("""select doc_id, n_chars from documents where text is not null and length(text) > 0 and published_at is not null""")
def e01_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.filter(T.has_text(F.col("text")) & F.col("published_at").isNotNull()).select("doc_id", "n_chars")


@R.add("""select doc_id, length(text) as len from documents where length(text) between 40 and 280""")
def e02_length_between(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter(F.length("text").between(40, 280)).select("doc_id", F.length("text").alias("len"))


@R.add("""select kind, count(*) as n from documents where length(text) >= 10 group by kind""")
def e03_min_length(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter(F.length("text") >= 10).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@R.add("""
select doc_id, substr(ts, 1, 4) as y, substr(ts, 1, 7) as ym, substr(ts, 6) as rest, substr(ts, 1, 10) as d
from (select doc_id, strftime(published_at at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as ts from documents)""")
def e04_time_substrings(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")
    d = table(spark, sf, "documents").select("doc_id", ts.alias("ts"))
    return d.select("doc_id", F.substring("ts", 1, 4).alias("y"), F.substring("ts", 1, 7).alias("ym"), F.expr("substring(ts, 6)").alias("rest"), F.substring("ts", 1, 10).alias("d"))


@R.add(r"""
select row_id, 'st_' || regexp_extract(source_url, '/status/(\d+)', 1) as status_id
from posts where regexp_extract(source_url, '/status/(\d+)', 1) <> ''""")
def e05_url_id(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "posts").select("row_id", T.url_id(F.col("source_url"), "st_").alias("status_id")).filter("status_id is not null")


@R.add("""select row_id, coalesce(nullif(title, ''), nullif(location, ''), nullif(event_type, ''), id) as shown from speeches""")
def e06_first_filled(spark: SparkSession, sf: str) -> DataFrame:
    c = [F.col(x) for x in ("title", "location", "event_type", "id")]
    return table(spark, sf, "speeches").select("row_id", T.first_filled(*c).alias("shown"))


@R.add(r"""
with h as (select row_id, '<p>' || coalesce(title, '') || '</p>' || chr(10) || '<div class="x">' || coalesce(location, '') || ' &amp; more</div>' as html, coalesce(title, '') as plain from speeches)
select row_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ') as body,
       case when contains(plain, '<') and contains(plain, '>') then trim(regexp_replace(regexp_replace(plain, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ') else plain end as same
from h""")
def e07_strip_html(spark: SparkSession, sf: str) -> DataFrame:
    title, place = F.coalesce("title", F.lit("")), F.coalesce("location", F.lit(""))
    html = F.concat(F.lit("<p>"), title, F.lit("</p>\n"), F.lit('<div class="x">'), place, F.lit(" &amp; more</div>"))
    return table(spark, sf, "speeches").select("row_id", T.strip_html(html).alias("body"), T.strip_html(title).alias("same"))


@R.add("""
select row_id, (is_repost is true) as repost, (reply_to is not null or starts_with(coalesce(text, ''), '@')) as reply from posts""")
def e08_flags(spark: SparkSession, sf: str) -> DataFrame:
    reply = F.col("reply_to").isNotNull() | F.coalesce("text", F.lit("")).startswith("@")
    return table(spark, sf, "posts").select("row_id", F.coalesce("is_repost", F.lit(False)).alias("repost"), reply.alias("reply"))


@R.add("""
with m as (select row_id, unnest(json_extract(try_cast(media_urls_json as json), '$[*]')) as x, generate_subscripts(json_extract(try_cast(media_urls_json as json), '$[*]'), 1) as i from posts where media_urls_json is not null),
u as (select row_id, i, case when json_type(x) = 'VARCHAR' then x->>'$' else coalesce(x->>'$.url', x->>'$.preview_url', x->>'$.remote_url') end as url from m)
select row_id, string_agg(url, ' ' order by i) as urls, count(url) as n from u where url is not null group by row_id""")
def e09_media_urls(spark: SparkSession, sf: str) -> DataFrame:
    """URLs of media entries that are strings or objects with one of three names."""
    entries = F.from_json("media_urls_json", "array<string>")
    get = lambda x: F.when(x.startswith("{"), F.coalesce(*[F.get_json_object(x, f"$.{n}") for n in ("url", "preview_url", "remote_url")])).otherwise(x)
    urls = F.filter(F.transform(entries, get), lambda u: u.isNotNull())
    p = table(spark, sf, "posts").select("row_id", urls.alias("u")).filter(F.size("u") > 0)
    return p.select("row_id", F.array_join("u", " ").alias("urls"), F.size("u").cast("long").alias("n"))


_METRICS = ["favourites_count", "reblogs_count", "replies_count", "quote_count", "views"]


@R.add("""
with m as (select row_id, json_extract_string(j, '$.favourites_count') as a, json_extract_string(j, '$.reblogs_count') as b, json_extract_string(j, '$.replies_count') as c, json_extract_string(j, '$.quote_count') as d, json_extract_string(j, '$.views') as e
  from (select row_id, try_cast(metrics_json as json) as j from posts where metrics_json is not null))
select row_id, k as metric, v as value from (
  select row_id, unnest(['favourites_count', 'reblogs_count', 'replies_count', 'quote_count', 'views']) as k, unnest([a, b, c, d, e]) as v from m) where v is not null""")
def e10_sparse_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The non-null ones of five metrics, as a map and then as rows."""
    pairs = [x for n in _METRICS for x in (F.lit(n), F.get_json_object("metrics_json", f"$.{n}"))]
    # Whole valid objects only: broken JSON has no metrics at all.
    valid = F.try_parse_json("metrics_json").isNotNull()
    m = table(spark, sf, "posts").filter(valid).select("row_id", F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("m"))
    return m.select("row_id", F.explode("m").alias("metric", "value"))


@R.add(r"""
select row_id, epoch_us(try_cast(timestamp_utc as timestamp)) // 1000000 as s from posts
where regexp_full_match(timestamp_utc, '\d{4}-\d\d-\d\d \d\d:\d\d:\d\d') and try_cast(timestamp_utc as timestamp) is not null""")
def e11_plain_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "posts").filter(F.col("timestamp_utc").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"))
    return p.select("row_id", F.unix_seconds(F.try_to_timestamp("timestamp_utc", F.lit("yyyy-MM-dd HH:mm:ss"))).alias("s")).filter("s is not null")


@R.add(r"""
select row_id, epoch_us(try_strptime(timestamp_utc, '%Y%m%d%H%M%S')) // 1000000 as s from posts
where regexp_full_match(timestamp_utc, '\d{14}') and try_strptime(timestamp_utc, '%Y%m%d%H%M%S') is not null""")
def e12_compact_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "posts").filter(F.col("timestamp_utc").rlike(r"^\d{14}$"))
    return p.select("row_id", F.unix_seconds(F.try_to_timestamp("timestamp_utc", F.lit("yyyyMMddHHmmss"))).alias("s")).filter("s is not null")


@R.add("""select count(*) as n from documents where published_at >= timestamptz '2021-01-09 00:00:00+00'""")
def e13_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter(F.col("published_at") >= F.lit("2021-01-09 00:00:00").cast("timestamp")).agg(F.count(F.lit(1)).alias("n"))


@R.add("""select row_id, 'sp_' || substr(sha1(coalesce(title, '') || substr(coalesce(text, ''), 1, 200)), 1, 16) as sid from speeches""")
def e14_surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "speeches").select("row_id", T.surrogate_id("sp_", F.col("title"), F.substring("text", 1, 200)).alias("sid"))


_TITLES = [("(?i)press conference", "press"), ("(?i)interview", "interview"), ("(?i)address", "address"), ("(?i)remarks", "remarks"), ("(?i)statement", "statement"), ("(?i)rally", "rally"), ("(?i)briefing", "briefing")]


@R.add("""
select row_id, case when regexp_matches(t, '(?i)press conference') then 'press' when regexp_matches(t, '(?i)interview') then 'interview' when regexp_matches(t, '(?i)address') then 'address'
  when regexp_matches(t, '(?i)remarks') then 'remarks' when regexp_matches(t, '(?i)statement') then 'statement' when regexp_matches(t, '(?i)rally') then 'rally' when regexp_matches(t, '(?i)briefing') then 'briefing' else 'other' end as label
from (select row_id, coalesce(title, '') as t from speeches)""")
def e15_classify_title(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "speeches").select("row_id", T.classify(F.coalesce("title", F.lit("")), _TITLES).alias("label"))


@R.add(r"""
with x as (select row_id, regexp_extract(title, ' in ([A-Z][a-z]+)', 1) as a, nullif(location, '') as l from speeches)
select row_id, coalesce(l, nullif(a, ''), 'unknown') as place from x""")
def e16_place(spark: SparkSession, sf: str) -> DataFrame:
    """The place as given, else the one named in the title."""
    named = F.regexp_extract(F.col("title"), " in ([A-Z][a-z]+)", 1)
    return table(spark, sf, "speeches").select("row_id", T.first_filled(F.col("location"), named, F.lit("unknown")).alias("place"))


@R.add(r"""
with x as (select row_id, regexp_extract(event_date, '^([A-Z][a-z]+ \d{1,2}, \d{4})', 1) as d from speeches)
select row_id, strftime(try_strptime(replace(d, ',', ''), '%B %d %Y'), '%Y-%m-%d') as iso from x where d <> '' and try_strptime(replace(d, ',', ''), '%B %d %Y') is not null""")
def e17_month_name_dates(spark: SparkSession, sf: str) -> DataFrame:
    d = F.replace(F.regexp_extract("event_date", r"^([A-Z][a-z]+ \d{1,2}, \d{4})", 1), F.lit(","), F.lit(""))
    return table(spark, sf, "speeches").select("row_id", F.date_format(F.try_to_timestamp(d, F.lit("MMMM d yyyy")), "yyyy-MM-dd").alias("iso")).filter("iso is not null")


@R.add("""
select row_id, substr(text, 1, 240) as head, substr(title, 1, 20) as short, case when length(text) > 120 then substr(text, 1, 117) || '...' else text end as note from speeches""")
def e18_truncate(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "speeches").select("row_id", F.substring("text", 1, 240).alias("head"), F.substring("title", 1, 20).alias("short"), T.shorten(F.col("text"), 120).alias("note"))


@R.add(r"""
select row_id, md5(trim(regexp_replace(regexp_replace(text, 'https?://[^ \t\n\r\f\v]+', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ')) as h from posts where text is not null""")
def e19_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "posts").filter("text is not null").select("row_id", F.md5(T.collapse(T.without_urls(F.col("text")))).alias("h"))


@R.add("""
select row_id, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') as safe from speeches""")
def e20_escape_html(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "speeches").select("row_id", T.escape_html(F.col("title")).alias("safe"))


@R.add("""select doc_id, strftime(published_at at time zone 'UTC', '%b %d, %Y  %H:%M') as shown from documents where published_at is not null""")
def e21_shown_time(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("published_at is not null").select("doc_id", timeparts.shown(F.col("published_at"), F.lit("")).alias("shown"))


@R.add("""
select t.post_id, t.theme, coalesce(c.label, t.theme) as label, count(*) as n from post_themes t left join theme_catalog c on c.slug = lower(trim(t.theme)) group by all""")
def e22_label_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "theme_catalog").select(F.col("slug").alias("_slug"), "label")
    t = table(spark, sf, "post_themes").withColumn("_slug", F.lower(F.trim("theme")))
    return t.join(c, "_slug", "left").groupBy("post_id", "theme", F.coalesce("label", "theme").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@R.add("""
select kind, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 4) as share from documents group by kind""")
def e23_percent_share(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    n = table(spark, sf, "documents").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return n.select("kind", "n", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4).alias("share"))


@R.add("""
select source_id, regexp_matches(lower(concat_ws(' ', name, url, notes)), 'gazette|transcripts|feed') as wanted from sources""")
def e25_any_token(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sources").select("source_id", F.lower(F.concat_ws(" ", "name", "url", "notes")).rlike("gazette|transcripts|feed").alias("wanted"))


@R.add(r"""
with x as (select row_id, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\v]+')) as words, length(coalesce(text, '')) as dur, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) as letters from posts)
select case when words < 3 then 'few_words' when dur < 20 or dur > 250 then 'duration' when letters < 10 then 'few_letters' else 'kept' end as reason, count(*) as n from x group by 1""")
def e26_drop_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """The first failing quality rule of each row, counted."""
    t = F.coalesce("text", F.lit(""))
    words, letters, dur = F.size(F.regexp_extract_all(t, F.lit(r"(\S+)"), F.lit(1))), F.length(F.regexp_replace(t, "[^A-Za-z]", "")), F.length(t)
    reason = F.when(words < 3, "few_words").when((dur < 20) | (dur > 250), "duration").when(letters < 10, "few_letters").otherwise("kept")
    return table(spark, sf, "posts").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@R.add("""select count(*) as n from events where event_type <> 'click' or value between 10 and 50""")
def e27_window_predicate(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter((F.col("event_type") != "click") | F.col("value").between(10, 50)).agg(F.count(F.lit(1)).alias("n"))


@R.add("""
select doc_id, isodow(l) - 1 as dow, hour(l) as hour, strftime(l, '%Y-%m') as month, strftime(l, '%Y-%m-%d') as day, year(l) as year, dayofyear(l) - 1 as day_index
from (select doc_id, published_at at time zone 'America/New_York' as l from documents where published_at is not null)""")
def e28_local_parts(spark: SparkSession, sf: str) -> DataFrame:
    d = timeparts.with_local_time(table(spark, sf, "documents").filter("published_at is not null"), "published_at", "America/New_York")
    return d.select("doc_id", "dow", "hour", "month", "day", "year", "day_index")


@R.add("""select source_id, '{"source_id":"' || source_id || '","record_count":' || record_count || '}' as j from sources where record_count is not null""")
def e29_record_json(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources").filter("record_count is not null")
    return s.select("source_id", F.to_json(F.struct("source_id", "record_count")).alias("j"))


@R.add(r"""
with w as (select doc_id, list_filter(regexp_extract_all(text, '[A-Za-z][A-Za-z'']+'), lambda x: length(x) >= 3) as ws from documents where text is not null)
select doc_id, round(case when len(ws) > 0 then len(list_filter(ws, lambda x: x = upper(x)))::double / len(ws) else 0 end, 6) as caps from w""")
def e30_caps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", F.round(T.caps_share(F.col("text")), 6).alias("caps"))


@R.add("""
select doc_id, round(case when length(text) > 0 then (length(text) - length(replace(text, '!', '')))::double / length(text) * 100 else 0 end, 6) as excl from documents where text is not null""")
def e31_exclamations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", F.round(T.exclamation_density(F.col("text")), 6).alias("excl"))


@R.add("""
select slug, case anchor_count when 6 then 'six' when 7 then 'seven' else 'other' end as name, coalesce(color, '#888888') as color from theme_catalog""")
def e33_value_map(spark: SparkSession, sf: str) -> DataFrame:
    names = F.create_map(F.lit(6), F.lit("six"), F.lit(7), F.lit("seven"))
    return table(spark, sf, "theme_catalog").select("slug", F.coalesce(F.element_at(names, F.col("anchor_count")), F.lit("other")).alias("name"), F.coalesce("color", F.lit("#888888")).alias("color"))


QUERIES, SQL = R.queries, R.sql
