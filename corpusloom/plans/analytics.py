"""Joins, aggregations, windows, top-k, set operations, text and vector analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import sentiment, stats, timeparts
from corpusloom.functions import text as T
from corpusloom.operators import ordered, rules, terms, upsert, vectors
from corpusloom.plans.registry import Registry
from corpusloom.session import table

R = Registry()
NY = "America/New_York"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _local_docs(spark: SparkSession, sf: str) -> DataFrame:
    return timeparts.with_local_time(_docs(spark, sf).filter("published_at is not null"), "published_at", NY)


# The same local projection in SQL.
_L = "(select *, published_at at time zone 'America/New_York' as l from documents where published_at is not null)"
_THEMED = "(select distinct on (post_id) post_id, lower(trim(theme)) as theme, score from post_themes where score is not null and not isnan(score) order by post_id, score desc, lower(trim(theme)))"


def _primary(spark: SparkSession, sf: str) -> DataFrame:
    """(post_id, theme, score): the best theme of each post."""
    t = table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).select("post_id", F.lower(F.trim("theme")).alias("theme"), "score")
    return upsert.keep_first(t, ["post_id"], [F.desc("score"), F.col("theme")])


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per post: its first delivery."""
    p = table(spark, sf, "posts").select("id", "row_id", "account", "text", "feed", "file_no", "is_repost", "ingested_at")
    return upsert.keep_first(p, ["id"], [F.col("row_id")])


_POSTS = "(select distinct on (id) id, row_id, account, text, feed, file_no, is_repost, ingested_at from posts order by id, row_id)"

# ---------------------------------------------------------------- joins


@R.add(f"""select p.id, p.account, t.theme, t.score from {_POSTS} p join {_THEMED} t on t.post_id = p.id where t.theme = 'harbors'""")
def j01_posts_of_theme(spark: SparkSession, sf: str) -> DataFrame:
    t = _primary(spark, sf).filter("theme = 'harbors'")
    return _posts(spark, sf).join(t, F.col("id") == F.col("post_id")).select("id", "account", "theme", "score")


@R.add("""
select strftime(p.ingested_at at time zone 'UTC', '%Y-%m') as month, lower(trim(t.theme)) as theme, count(*) as n
from posts p join post_themes t on t.post_id = p.id where t.rank = 1 group by all""")
def j02_month_theme(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "post_themes").filter("rank = 1").select("post_id", F.lower(F.trim("theme")).alias("theme"))
    p = table(spark, sf, "posts").select("id", F.date_format("ingested_at", "yyyy-MM").alias("month"))
    return p.join(t, F.col("id") == F.col("post_id")).groupBy("month", "theme").agg(F.count("*").alias("n"))


@R.add("""
with r as (select post_id, min(lower(trim(theme))) as theme from post_themes where rank = 1 group by 1)
select p.row_id, r.theme from posts p left join r on r.post_id = p.id""")
def j03_left_rank1(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "post_themes").filter("rank = 1").groupBy("post_id").agg(F.min(F.lower(F.trim("theme"))).alias("theme"))
    return table(spark, sf, "posts").select("row_id", "id").join(r, F.col("id") == F.col("post_id"), "left").select("row_id", "theme")


@R.add("""
select d.doc_id, coalesce((select s.name from sources s where s.source_id = d.source), 'unknown') as source_name from documents d""")
def j04_scalar_default(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources").select("source_id", "name")
    return _docs(spark, sf).select("doc_id", "source").join(s, F.col("source") == F.col("source_id"), "left").select("doc_id", F.coalesce("name", F.lit("unknown")).alias("source_name"))


@R.add("""select count(*) as n from (select distinct id from posts) p where not exists (select 1 from post_themes t where t.post_id = p.id)""")
def j05_anti(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "post_themes").select(F.col("post_id").alias("id"))
    return upsert.not_done(table(spark, sf, "posts").select("id").distinct(), done, "id").agg(F.count("*").alias("n"))


@R.add("""select row_id from posts where id in (select post_id from post_vectors where label = 3)""")
def j06_semi(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "post_vectors").filter("label = 3").select(F.col("post_id").alias("id"))
    return table(spark, sf, "posts").select("row_id", "id").join(v, "id", "left_semi").select("row_id")


@R.add(f"""
select p.account, count(*) as n, count(t.theme) as n_themed, count(*) filter (t.theme = 'harbors') as n_harbors from {_POSTS} p left join {_THEMED} t on t.post_id = p.id group by 1""")
def j07_lookup_optional(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a match count in the total but not in the themed series."""
    j = _posts(spark, sf).join(_primary(spark, sf), F.col("id") == F.col("post_id"), "left")
    return j.groupBy("account").agg(F.count("*").alias("n"), F.count("theme").alias("n_themed"), F.count(F.when(F.col("theme") == "harbors", 1)).alias("n_harbors"))


@R.add("""
with c as (select label, list_transform(generate_series(1, 64), lambda i: avg_at[i]) as m from (
  select label, list(a order by pos) as avg_at from (select label, pos, avg(x) as a from (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings) group by 1, 2) group by 1)),
n as (select label, list_transform(m, lambda x: x / (sqrt(list_dot_product(m, m)) + 1e-9)) as c from c),
v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings)
select v.vec_id, n.label, round(list_dot_product(v.e, n.c) / sqrt(list_dot_product(v.e, v.e)), 6) as score from v, n""")
def j09_similarity_matrix(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return vectors.similarities(e, "vec_id", "embedding", vectors.centroids(e, "label", "embedding"))


@R.add("""
with y as (select year(o_orderdate) as year, count(*) as n from orders group by 1),
want as (select unnest([1990, 1996, 1999, 2005]) as target),
c as (select target, year, n, row_number() over (partition by target order by abs(year - target), year) as k from want, y)
select target::bigint as target, year, n from c where k = 1""")
def j14_nearest_year(spark: SparkSession, sf: str) -> DataFrame:
    """For each wanted year the nearest year that has data (ties: the earlier)."""
    y = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    years = y.agg(F.array_sort(F.collect_list(F.struct("year", "n"))).alias("all"))
    want = spark.createDataFrame([(t,) for t in (1990, 1996, 1999, 2005)], "target long").join(years)
    best = F.array_sort(F.transform("all", lambda e: F.struct(F.abs(e["year"] - F.col("target")).alias("d"), e["year"].alias("year"), e["n"].alias("n"))))[0]
    return want.select("target", best.alias("b")).select("target", "b.year", "b.n")


@R.add("""
with b as (select user_id, count(*) as v from events where ts < timestamp '2024-01-16' group by 1), a as (select user_id, count(*) as v from events group by 1)
select user_id, coalesce(b.v, 0) as before, coalesce(a.v, 0) as after, coalesce(a.v, 0) - coalesce(b.v, 0) as delta from b full join a using (user_id)""")
def j15_snapshot_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Two states of one table: before a date, and all of it."""
    e = table(spark, sf, "events")
    count = lambda rows: rows.groupBy("user_id").agg(F.count("*").alias("v"))
    return upsert.snapshot_delta(count(e.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))), count(e), ["user_id"], "v")


@R.add("""
select n.n_name, r.r_name, count(distinct c.c_custkey) as customers, count(o.o_orderkey) as orders, round(sum(o.o_totalprice), 2) as total
from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey left join orders o on o.o_custkey = c.c_custkey group by 1, 2""")
def j16_star_join(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("t"))
    c = table(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    j = c.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name", "r_name").agg(F.countDistinct("c_custkey").alias("customers"), F.coalesce(F.sum("k"), F.lit(0)).alias("orders"), F.round(F.sum("t"), 2).alias("total"))


# ---------------------------------------------------------------- aggregations


@R.add("""select count(*) as n, count(text) as n_text from documents""")
def a01_count(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).agg(F.count("*").alias("n"), F.count("text").alias("n_text"))


@R.add("""
select platform, account, count(*) as n, strftime(min(ingested_at) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as first, strftime(max(ingested_at) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as last from posts group by 1, 2""")
def a02_account_summary(spark: SparkSession, sf: str) -> DataFrame:
    f = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "posts").groupBy("platform", "account").agg(F.count("*").alias("n"), f(F.min("ingested_at")).alias("first"), f(F.max("ingested_at")).alias("last"))


@R.add("""select year(published_at at time zone 'UTC') as year, count(*) as n from documents where published_at is not null group by 1""")
def a03_volume_year(spark: SparkSession, sf: str) -> DataFrame:
    return timeparts.with_local_time(_docs(spark, sf).filter("published_at is not null"), "published_at").groupBy("year").agg(F.count("*").alias("n"))


@R.add("""select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders where year(o_orderdate) = 1998 group by 1""")
def a04_months_of_year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.year("o_orderdate") == 1998).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@R.add(f"""select theme, count(*) as n, round(100.0::double * count(*) / sum(count(*)) over (), 4) as share from {_THEMED} group by 1""")
def a05_primary_share(spark: SparkSession, sf: str) -> DataFrame:
    n = _primary(spark, sf).groupBy("theme").agg(F.count("*").alias("n"))
    return n.select("theme", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"))


@R.add(f"""select t.theme, year(p.ingested_at at time zone 'UTC') as year, count(*) as n from {_POSTS} p join {_THEMED} t on t.post_id = p.id group by 1, 2""")
def a06_theme_year(spark: SparkSession, sf: str) -> DataFrame:
    j = _posts(spark, sf).join(_primary(spark, sf), F.col("id") == F.col("post_id"))
    return j.groupBy("theme", F.year("ingested_at").alias("year")).agg(F.count("*").alias("n"))


@R.add("""
select lower(trim(theme)) as theme, count(distinct post_id) as n from post_themes group by 1 order by n desc, theme limit 20""")
def a07_distinct_top20(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "post_themes").groupBy(F.lower(F.trim("theme")).alias("theme")).agg(F.countDistinct("post_id").alias("n"))
    return g.orderBy(F.desc("n"), "theme").limit(20)


@R.add("""select round(avg(n), 6) as labels_per_post from (select post_id, count(distinct lower(trim(theme))) as n from post_themes group by 1)""")
def a08_labels_per_item(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "post_themes").groupBy("post_id").agg(F.countDistinct(F.lower(F.trim("theme"))).alias("n"))
    return g.agg(F.round(F.avg("n"), 6).alias("labels_per_post"))


@R.add(f"""
with c as (select strftime(l, '%Y-%m') as month, kind, count(*) as n from {_L} group by 1, 2)
select m.month, k.kind, coalesce(c.n, 0) as n from (select distinct month from c) m cross join (select distinct kind from c) k left join c on c.month = m.month and c.kind = k.kind""")
def a09_dense_stream(spark: SparkSession, sf: str) -> DataFrame:
    c = _local_docs(spark, sf).groupBy("month", "kind").agg(F.count("*").alias("n"))
    return stats.dense(c, [c.select("month").distinct(), c.select("kind").distinct()], ["month", "kind"], "n").select("month", "kind", "n")


@R.add(f"""
with c as (select isodow(l) - 1 as dow, hour(l) as hour, count(*) as n from {_L} group by 1, 2)
select d.dow, h.hour, coalesce(c.n, 0) as n from (select unnest(generate_series(0, 6)) as dow) d cross join (select unnest(generate_series(0, 23)) as hour) h left join c on c.dow = d.dow and c.hour = h.hour""")
def a10_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    c = _local_docs(spark, sf).groupBy("dow", "hour").agg(F.count("*").alias("n"))
    axis = lambda name, n: spark.range(n).select(F.col("id").cast("int").alias(name))
    return stats.dense(c, [axis("dow", 7), axis("hour", 24)], ["dow", "hour"], "n").select("dow", "hour", "n")


@R.add(f"""
select dow, hour, doc_id from (select isodow(l) - 1 as dow, hour(l) as hour, doc_id, row_number() over (partition by isodow(l), hour(l) order by md5(doc_id::varchar), doc_id) as k from {_L}) where k <= 3""")
def a11_cell_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Three items of each cell, drawn by a hash: the same in every run."""
    got = stats.top_per_group(_local_docs(spark, sf).select("dow", "hour", "doc_id"), ["dow", "hour"], [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")], 3)
    return got.select("dow", "hour", "doc_id")


@R.add(f"""select strftime(l, '%Y-%m-%d') as day, count(*) as n from {_L} group by 1""")
def a12_days(spark: SparkSession, sf: str) -> DataFrame:
    return _local_docs(spark, sf).groupBy("day").agg(F.count("*").alias("n"))


@R.add(f"""
select month, kind from (select strftime(l, '%Y-%m') as month, kind, row_number() over (partition by strftime(l, '%Y-%m') order by count(*) desc, kind) as k from {_L} where kind is not null group by 1, 2) where k = 1""")
def a13_mode(spark: SparkSession, sf: str) -> DataFrame:
    return stats.mode_by(_local_docs(spark, sf).filter("kind is not null"), ["month"], "kind", "kind").select("month", "kind")


@R.add(f"""
with w as (select strftime(l, '%Y-%m') as month, list_filter(regexp_extract_all(text, '[A-Za-z][A-Za-z'']+'), lambda x: length(x) >= 3) as ws, text from {_L} where length(text) >= 10),
v as (select month, case when len(ws) > 0 then len(list_filter(ws, lambda x: x = upper(x)))::double / len(ws) else 0 end as caps, (length(text) - length(replace(text, '!', '')))::double / length(text) * 100 as excl from w),
g as (select month, count(*) as n, avg(caps) as caps, avg(excl) as excl, list_sort(list(caps)) as lc, list_sort(list(excl)) as le from v group by 1 having count(*) >= 5),
p as (select *, least(greatest((9 * (n + 1)) // 10, 1), n - 1) as j from g)
select month, n, round(caps, 4) as caps, round(excl, 4) as excl,
  round(case when n < 10 then list_max(lc) else (lc[j] * (10 - (9 * (n + 1) - 10 * j)) + lc[j + 1] * (9 * (n + 1) - 10 * j)) / 10 end, 4) as caps_p90,
  round(case when n < 10 then list_max(le) else (le[j] * (10 - (9 * (n + 1) - 10 * j)) + le[j + 1] * (9 * (n + 1) - 10 * j)) / 10 end, 4) as excl_p90
from p""")
def a14_style_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and exclusive 90 % quantile of two style indices; thin months dropped, small ones use the maximum."""
    d = _local_docs(spark, sf).filter(F.length("text") >= 10).select("month", T.caps_share(F.col("text")).alias("c"), T.exclamation_density(F.col("text")).alias("e"))
    g = d.groupBy("month").agg(F.round(F.avg("c"), 4).alias("caps"), F.round(F.avg("e"), 4).alias("excl"))
    for c, name in (("c", "caps_p90"), ("e", "excl_p90")):
        q = stats.exclusive_decile_by(d, ["month"], c)
        g = g.join(q.select("month", "n", F.round(F.when(F.col("n") < 10, F.col("top")).otherwise(F.col("decile")), 4).alias(name)), ["month"] if "n" not in g.columns else ["month", "n"])
    return g.filter("n >= 5").select("month", "n", "caps", "excl", "caps_p90", "excl_p90")


# The lexicon of the queries: words and valences chosen for texts like those of the tables.
_LEXICON = {
    "abandon": -1.8, "applaud": 2.0, "badly": -1.9, "beloved": 2.3, "bitter": -1.8, "brilliant": 2.8, "broken": -2.1, "careful": 0.9, "careless": -1.7, "celebrate": 2.6,
    "cheap": -0.8, "complaints": -1.6, "conceal": -1.3, "costly": -1.2, "crooked": -2.5, "crowded": -0.6, "dangerous": -2.2, "defend": 0.8, "delay": -1.1, "denounce": -1.7,
    "disputed": -1.7, "empty": -0.8, "endless": -0.7, "failing": -2.3, "fairly": 1.0, "famous": 1.7, "forgotten": -0.9, "fragile": -0.8, "friend": 2.2, "furious": -2.7,
    "generous": 2.3, "gilded": 0.6, "gladly": 1.9, "great": 3.1, "harmless": 1.0, "hated": -3.2, "hollow": -1.2, "honest": 2.3, "honestly": 1.5, "honor": 2.2,
    "humble": 1.2, "ignore": -1.5, "insure": 0.6, "lawful": 1.1, "lazy": -1.5, "losing": -1.6, "loyal": 2.1, "mock": -1.8, "noisy": -0.9, "patient": 1.1,
    "polished": 1.1, "praise": 2.6, "protect": 1.6, "proud": 2.1, "proudly": 1.9, "punish": -2.4, "reckless": -2.0, "refund": 0.4, "reject": -1.7, "repair": 0.7,
    "rescue": 2.3, "restore": 1.2, "reward": 2.7, "rotten": -2.3, "sacred": 1.8, "shaky": -1.0, "sloppy": -1.5, "splendid": 2.8, "steady": 0.9, "strange": -0.8,
    "stubborn": -1.2, "sturdy": 1.0, "suspend": -1.2, "thrifty": 0.9, "unfair": -2.1, "uphold": 0.9, "wasteful": -1.9, "winning": 2.4, "wrongly": -1.8,
}
_VALUES = lambda d: ", ".join(f"('{w}', {v}::double)" for w, v in d.items())
_WORDS = lambda ws: ", ".join(f"'{w}'" for w in ws)
_STRIP = r"""regexp_replace(t, '^[!-/:-@\x5b-`{-~]+|[!-/:-@\x5b-`{-~]+$', '', 'g')"""


def _degree(k: int) -> str:
    """The valence after the word at distance ``k``: degree, then negation."""
    p, before = f"p{k}", f"v{k - 1}"
    degree = f"case when {before} > 0 then 1 else -1 end * ({p}.b + case when mixed and {p}.c then 0.733 else 0 end) * {(1.0, 0.95, 0.9)[k - 1]}"
    return f"case when {p}.x then {before} else ({before} + case when {p}.b <> 0 then {degree} else 0 end) * case when {p}.n then -0.74 else 1 end end"


_SENT = f"""(
with lex(w, v) as (values {_VALUES(_LEXICON)}), boost(w, b) as (values {_VALUES(sentiment.BOOSTERS)}),
raw as (select doc_id, unnest(ts) as t, generate_subscripts(ts, 1) as i from (select doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') as ts from documents where text is not null)),
bare as (select doc_id, i, case when length({_STRIP}) > 2 then {_STRIP} else t end as t from raw),
tok as (select doc_id, i, lower(t) as w, regexp_full_match(t, '[^a-z]*[A-Z][^a-z]*') as c from bare),
doc as (select doc_id, count(*) filter (c) between 1 and count(*) - 1 as mixed, min(i) filter (w = 'but') as but from tok group by 1),
att as (select doc_id, i, w, c, lex.v, lex.v is not null as x, coalesce(b, 0) as b, w in ({_WORDS(sentiment.NEGATIONS)}) or ends_with(w, 'n''t') as n from tok left join lex using (w) left join boost using (w)),
lagged as (select doc_id, i, c, v, lag(att, 1) over o as p1, lag(att, 2) over o as p2, lag(att, 3) over o as p3 from att window o as (partition by doc_id order by i)),
s0 as (select doc_id, i, mixed, but, case when p1 is null then {{'x': true, 'b': 0::double, 'n': false, 'c': false}} else {{'x': p1.x, 'b': p1.b, 'n': p1.n, 'c': p1.c}} end as p1, case when p2 is null then {{'x': true, 'b': 0::double, 'n': false, 'c': false}} else {{'x': p2.x, 'b': p2.b, 'n': p2.n, 'c': p2.c}} end as p2,
  case when p3 is null then {{'x': true, 'b': 0::double, 'n': false, 'c': false}} else {{'x': p3.x, 'b': p3.b, 'n': p3.n, 'c': p3.c}} end as p3, v + case when mixed and c then case when v > 0 then 0.733 else -0.733 end else 0 end as v0 from lagged join doc using (doc_id) where v is not null),
s1 as (select *, {_degree(1)} as v1 from s0), s2 as (select *, {_degree(2)} as v2 from s1), s3 as (select *, {_degree(3)} as v3 from s2),
summed as (select doc_id, sum(v3 * case when but is null or i = but then 1 when i < but then 0.5 else 1.5 end) as s from s3 group by 1),
pushed as (select d.doc_id, coalesce(s, 0) as s, least(length(text) - length(replace(text, '!', '')), 4) * 0.292::double as e, length(text) - length(replace(text, '?', '')) as q from documents d left join summed using (doc_id) where text is not null),
total as (select doc_id, s + sign(round(s, 9)) * (e + case when q < 2 then 0 when q < 4 then q * 0.18::double else 0.96 end) as s from pushed)
select doc_id, round(s / sqrt(s * s + 15), 4) as compound from total)"""
_SCORED = f"(select * from {_L} join {_SENT} using (doc_id) where length(text) >= 10)"


@R.add(f"select doc_id, compound from {_SENT}")
def n06_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """The compound sentiment of every document."""
    return _docs(spark, sf).filter("text is not null").select("doc_id", sentiment.sentiment(F.col("text"), _LEXICON).alias("compound"))


@R.add(f"""select strftime(l, '%Y-%m') as month, count(*) as n, round(avg(compound), 4) as mean from {_SCORED} group by 1 having count(*) >= 5""")
def a15_sentiment_by_month(spark: SparkSession, sf: str) -> DataFrame:
    d = _local_docs(spark, sf).filter(F.length("text") >= 10).select("month", sentiment.sentiment(F.col("text"), _LEXICON).alias("s"))
    return d.groupBy("month").agg(F.count("*").alias("n"), F.round(F.avg("s"), 4).alias("mean")).filter("n >= 5")


@R.add(f"""select kind, strftime(l, '%Y-%m') as month, count(*) as n, round(avg(compound), 4) as mean from {_SCORED} group by 1, 2 having count(*) >= 5""")
def a15_sentiment_by_kind(spark: SparkSession, sf: str) -> DataFrame:
    d = _local_docs(spark, sf).filter(F.length("text") >= 10).select("kind", "month", sentiment.sentiment(F.col("text"), _LEXICON).alias("s"))
    return d.groupBy("kind", "month").agg(F.count("*").alias("n"), F.round(F.avg("s"), 4).alias("mean")).filter("n >= 5")


@R.add(f"""select count(distinct strftime(l, '%Y-%m')) as months, count(distinct kind) as kinds, count(distinct source) as sources from {_L}""")
def a16_distinct_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _local_docs(spark, sf).agg(F.countDistinct("month").alias("months"), F.countDistinct("kind").alias("kinds"), F.countDistinct("source").alias("sources"))


@R.add("""select account, min_by(row_id, (ingested_at, row_id)) as row_id from posts group by 1""")
def a20_min_by(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "posts").groupBy("account").agg(F.min_by("row_id", F.struct("ingested_at", "row_id")).alias("row_id"))


@R.add("""select event_type, count(*) as n, round(sum(value), 2) as total from events group by 1""")
def a21_sum_by_phase(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


_SCORE = "(select least(greatest(score, 0), 1) as s, lower(trim(theme)) as theme from post_themes where score is not null and not isnan(score))"


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).select(F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("s"), F.lower(F.trim("theme")).alias("theme"))


@R.add(f"""select least(floor(s * 20), 19)::bigint as bin, count(*) as n from {_SCORE} group by 1""")
def a22_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """20 bins of width 0.05 over 0 to 1, the last one closed."""
    return _scores(spark, sf).groupBy(F.least(F.floor(F.col("s") * 20), F.lit(19)).alias("bin")).agg(F.count("*").alias("n"))


@R.add(f"""select theme, count(*) as n, round(avg(s), 6) as mean, round(quantile_cont(s, 0.25), 6) as p25, round(quantile_cont(s, 0.5), 6) as p50, round(quantile_cont(s, 0.75), 6) as p75 from {_SCORE} group by 1""")
def a23_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    names = {f"p{int(p * 100)}": p for p in (0.25, 0.5, 0.75)}
    got = stats.quantiles_by(_scores(spark, sf), ["theme"], "s", names)
    return got.select("theme", "n", *[F.round(c, 6).alias(c) for c in ("mean", *names)])


@R.add("""
with p as (select label, pos, avg(x) as m from (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings) group by 1, 2),
n as (select label, pos, m / (sqrt(sum(m * m) over (partition by label)) + 1e-9) as c from p)
select label, pos - 1 as pos, round(c, 6) as c from n""")
def a24_centroids(spark: SparkSession, sf: str) -> DataFrame:
    c = vectors.centroids(table(spark, sf, "embeddings"), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("pos", "c")).select("label", F.col("pos").cast("long").alias("pos"), F.round("c", 6).alias("c"))


@R.add("""
with t as (select post_id, lower(trim(theme)) as theme, max(score) as score from post_themes where score is not null and not isnan(score) group by 1, 2)
select post_id, string_agg(theme, ',' order by score desc, theme) as labels from t group by 1""")
def a27_label_lists(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy("post_id", F.lower(F.trim("theme")).alias("theme")).agg(F.max("score").alias("score"))
    l = t.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("d"), "theme"))).alias("l"))  # noqa: E741
    return l.select("post_id", F.array_join(F.transform("l", lambda e: e["theme"]), ",").alias("labels"))


@R.add("""select count(distinct lower(trim(theme))) as n from post_themes where post_id in (select post_id from post_vectors where label = 1)""")
def a28_themes_of_selection(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "post_vectors").filter("label = 1").select("post_id")
    return table(spark, sf, "post_themes").join(v, "post_id", "left_semi").agg(F.countDistinct(F.lower(F.trim("theme"))).alias("n"))


# ---------------------------------------------------------------- windows


@R.add("""
with t as (select lower(trim(theme)) as theme, post_id, max(score) as score from post_themes where score is not null and not isnan(score) group by 1, 2),
r as (select *, row_number() over (partition by theme order by score desc, post_id) as rn, count(*) over (partition by theme) as n from t)
select theme, post_id, rn from r where rn <= greatest(1, n // 20)""")
def w01_top_share(spark: SparkSession, sf: str) -> DataFrame:
    """The best twentieth of each theme, one at least."""
    t = table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy(F.lower(F.trim("theme")).alias("theme"), "post_id").agg(F.max("score").alias("score"))
    n = t.groupBy("theme").agg(F.greatest(F.lit(1), F.floor(F.count("*") / 20)).alias("keep"))
    r = t.withColumn("rn", F.row_number().over(Window.partitionBy("theme").orderBy(F.desc("score"), "post_id")))
    return r.join(n, "theme").filter("rn <= keep").select("theme", "post_id", "rn")


@R.add("""
with d as (select strftime(o_orderdate, '%Y-%m-%d') as day, year(o_orderdate) as year, count(*) as n from orders group by 1, 2),
z as (select day, n, (n - avg(n) over (partition by year)) / case when stddev_pop(n) over (partition by year) = 0 then 1 else stddev_pop(n) over (partition by year) end as z from d)
select day, n, round(z, 2) as z from z where z > 3""")
def w02_storm_days(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return stats.zscore_within(d, "n", ["year"]).filter("z > 3").select("day", "n", F.round("z", 2).alias("z"))


@R.add("""
with m as (select strftime(o_orderdate, '%Y-%m') as month, round(avg(o_totalprice), 2) as mean from orders group by 1)
select month, mean, round(avg(mean) over (order by month rows between 2 preceding and current row), 4) as rolling from m""")
def w03_rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.round(F.avg("o_totalprice"), 2).alias("mean"))
    return stats.rolling_mean(m, "mean", "month").select("month", "mean", F.round("rolling", 4).alias("rolling"))


@R.add("""
with t as (select post_id, lower(trim(theme)) as theme, max(score) as score from post_themes where score is not null and not isnan(score) group by 1, 2)
select post_id, theme, k from (select *, row_number() over (partition by post_id order by score desc, theme) as k from t) where k <= 3""")
def w04_rank_per_item(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy("post_id", F.lower(F.trim("theme")).alias("theme")).agg(F.max("score").alias("score"))
    return stats.top_per_group(t, ["post_id"], [F.desc("score"), F.col("theme")], 3, "k").select("post_id", "theme", "k")


@R.add("""
with b as (select user_id, event_id, value, coalesce(sum(value) over (partition by user_id order by value desc, event_id rows between unbounded preceding and 1 preceding), 0) as before from events)
select user_id, event_id, round(before, 4) as before from b where before < 200""")
def w05_running_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    return stats.running_cutoff(e, ["user_id"], [F.desc("value"), F.col("event_id")], "value", 200.0).select("user_id", "event_id", F.round("before", 4).alias("before"))


@R.add("""
select user_id, event_id, lead(event_id) over (partition by user_id order by ts, event_id) as next_event from events""")
def w08_path(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").select("user_id", "event_id", F.lead("event_id").over(w).alias("next_event"))


# ---------------------------------------------------------------- top-k


@R.add(f"""
select post_id, score, strftime(ingested_at at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as at from (
  select t.post_id, t.score, p.ingested_at from {_THEMED} t join {_POSTS} p on p.id = t.post_id where t.theme = 'schools' order by t.score desc, t.post_id limit 50)""")
def t01_feed_top(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 best posts of a theme, then in order of time."""
    j = _primary(spark, sf).filter("theme = 'schools'").join(_posts(spark, sf), F.col("post_id") == F.col("id"))
    best = j.orderBy(F.desc("score"), "post_id").limit(50)
    return best.orderBy("ingested_at", "post_id").select("post_id", "score", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@R.add("""
select doc_id from documents where year(published_at at time zone 'UTC') = 2021 order by published_at, doc_id limit 300""")
def t02_first_of_year(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).filter(F.year("published_at") == 2021).orderBy("published_at", "doc_id").limit(300).select("doc_id")


@R.add("""select event_type, user_id, n from (select event_type, user_id, count(*) as n, row_number() over (partition by event_type order by count(*) desc, user_id) as k from events group by 1, 2) where k <= 5""")
def t03_most_common(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return stats.top_per_group(c, ["event_type"], [F.desc("n"), F.col("user_id")], 5).select("event_type", "user_id", "n")


@R.add(f"""
with top as (select theme, post_id from (select theme, post_id, row_number() over (partition by theme order by score desc, post_id) as k from {_THEMED}) where k <= 2),
fill as (select id as post_id from {_POSTS} where id not in (select post_id from top) order by ingested_at desc, id limit 100)
select post_id, 'top' as kind from top union all select post_id, 'recent' from fill""")
def t05_spread_and_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Two posts of every theme, filled up with the most recent others."""
    top = stats.top_per_group(_primary(spark, sf), ["theme"], [F.desc("score"), F.col("post_id")], 2).select("post_id")
    fill = upsert.not_done(_posts(spark, sf).select(F.col("id").alias("post_id"), "ingested_at"), top, "post_id").orderBy(F.desc("ingested_at"), "post_id").limit(100)
    return top.select("post_id", F.lit("top").alias("kind")).unionByName(fill.select("post_id", F.lit("recent").alias("kind")))


@R.add("""select doc_id, row_number() over (order by published_at nulls last, doc_id) as pos from documents where kind = 'speech'""")
def t06_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).filter("kind = 'speech'").select("doc_id", "published_at")
    return ordered.global_rank(d, [F.asc_nulls_last("published_at"), F.col("doc_id")], "pos").select("doc_id", "pos")


@R.add("""
with k as (select count(*) as n, greatest(1, count(*) // 20) as cut from speeches where event_type is not null)
select row_id, case when r <= cut then 'eval' else 'train' end as part from (select row_id, row_number() over (order by md5(row_id || ':7'), row_id) as r from speeches where event_type is not null), k""")
def t08_hash_split(spark: SparkSession, sf: str) -> DataFrame:
    """A twentieth for evaluation, the first ones in the order of a hash."""
    s = table(spark, sf, "speeches").filter("event_type is not null").select("row_id", F.md5(F.concat(F.col("row_id").cast("string"), F.lit(":7"))).alias("h"))
    cut = s.agg(F.greatest(F.lit(1), F.floor(F.count("*") / 20)).alias("cut"))
    ranked = ordered.global_rank(s, [F.col("h"), F.col("row_id")]).join(cut)
    return ranked.select("row_id", F.when(F.col("rank") <= F.col("cut"), "eval").otherwise("train").alias("part"))


@R.add("""
with t as (select post_id, lower(trim(theme)) as theme, max(score) as score from post_themes where score is not null and not isnan(score) group by 1, 2),
l as (select post_id, list(theme order by score desc, theme) as ls from t group by 1)
select distinct p.id, coalesce(l.ls[1], 'general') as main, coalesce(array_to_string(l.ls[2:3], ','), '') as others from posts p left join l on l.post_id = p.id""")
def t09_secondary_labels(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "post_themes").filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy("post_id", F.lower(F.trim("theme")).alias("theme")).agg(F.max("score").alias("score"))
    l = t.groupBy("post_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("d"), "theme"))), lambda e: e["theme"]).alias("ls"))  # noqa: E741
    p = table(spark, sf, "posts").select("id").distinct().join(l, F.col("id") == F.col("post_id"), "left")
    return p.select("id", F.coalesce(F.get("ls", F.lit(0)), F.lit("general")).alias("main"), F.coalesce(F.array_join(F.slice("ls", 2, 2), ","), F.lit("")).alias("others"))


# ---------------------------------------------------------------- set operations


@R.add("""
select origin, count(*) as n, count(platform) as n_platform, count(title) as n_title from (
  select 'posts' as origin, id, text, platform, null as title from posts union all select 'speeches', id, text, null, title from speeches) group by 1""")
def x01_append(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "posts").select(F.lit("posts").alias("origin"), "id", "text", "platform")
    s = table(spark, sf, "speeches").select(F.lit("speeches").alias("origin"), "id", "text", "title")
    return p.unionByName(s, allowMissingColumns=True).groupBy("origin").agg(F.count("*").alias("n"), F.count("platform").alias("n_platform"), F.count("title").alias("n_title"))


@R.add("""select distinct year(published_at at time zone 'UTC') as year, kind from documents where published_at is not null""")
def x02_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).filter("published_at is not null").select(F.year("published_at").alias("year"), "kind").distinct()


@R.add("""select id, min(row_id) as row_id from speeches group by 1""")
def x03_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.keep_first(table(spark, sf, "speeches").select("id", "row_id"), ["id"], [F.col("row_id")])


@R.add("""
with w as (select row_id, regexp_extract_all(lower(coalesce(title, '')), '[a-z]+') as ws from speeches)
select row_id, array_to_string([x for x, i in ws if list_position(ws, x) = i], ' ') as uniq from w""")
def x04_ordered_distinct(spark: SparkSession, sf: str) -> DataFrame:
    ws = F.regexp_extract_all(F.lower(F.coalesce("title", F.lit(""))), F.lit("([a-z]+)"), F.lit(1))
    return table(spark, sf, "speeches").select("row_id", F.array_join(F.array_distinct(ws), " ").alias("uniq"))


@R.add("""
select name, kind from (select n_name as name, 'nation' as kind from nation union all values ('HOME', 'fixed'), ('AWAY', 'fixed'))""")
def x05_constant_rows(spark: SparkSession, sf: str) -> DataFrame:
    fixed = spark.createDataFrame([("HOME", "fixed"), ("AWAY", "fixed")], "name string, kind string")
    return fixed.unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit("nation").alias("kind")))


# ---------------------------------------------------------------- text analytics

_RULES = [
    rules.Rule(r"\bgreat [a-z]+ news\b", "news", "good"), rules.Rule(r"\bcrooked\b", "crook", "bad"), rules.Rule(r"\bfailing [a-z]+", "failure", "bad"),
    rules.Rule(r"\bbroken [a-z]+", "failure", "bad"), rules.Rule(r"\b(?:proud|honest) [a-z]+", "virtue", "good"), rules.Rule(r"\bmy [a-z]+ friend\b", "friend", "good"),
    rules.Rule(r"\bcrowns\b", "money", "good"), rules.Rule(r"\bhated [a-z]+", "hate", "bad"), rules.Rule(r"\bproud\b", "pride", "good"), rules.Rule(r"\bcrooked\b", "villain", "bad"),
]
_CASES = " union all ".join(f"select doc_id, {i} as o, '{r.target}' as target, '{r.polarity}' as polarity, regexp_extract(text, '(?i)({r.pattern})', 1) as surface from documents" for i, r in enumerate(_RULES))
_HITS = f"(select doc_id, target, polarity, min_by(surface, o) as surface from ({_CASES}) where surface <> '' group by 1, 2, 3)"


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    # ASCII case folding and word limits, as the SQL has them.
    return rules.matches(_docs(spark, sf), "doc_id", "text", _RULES, flags="(?i)")


@R.add(f"select doc_id, target, polarity, surface from {_HITS}")
def n01_rule_hits(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf).select("doc_id", "target", "polarity", "surface")


@R.add(f"select doc_id, string_agg(distinct polarity, ',' order by polarity) as polarities from {_HITS} group by 1")
def n03_polarities(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf).groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("polarity")), ",").alias("polarities"))


@R.add(f"""
with g as (select target, polarity, count(*) as n from {_HITS} group by 1, 2),
r as (select *, sum(n) over (partition by target) as n_hits, row_number() over (partition by target order by n desc, polarity) as k from g)
select target, n_hits::bigint as n_hits, polarity from r where k = 1 order by n_hits desc, target limit 30""")
def a17_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return rules.leaderboard(_hits(spark, sf), "doc_id")


@R.add(f"""
select lower(surface) as surface, count(distinct target) as n_targets, count(*) as total, string_agg(distinct target, ',' order by target) as targets from {_HITS}
group by 1 having count(distinct target) > 1 order by total desc, surface limit 20""")
def a17_shared_surfaces(spark: SparkSession, sf: str) -> DataFrame:
    return rules.shared_surfaces(_hits(spark, sf))


@R.add(f"""
with s as (select target, surface, count(*) as n from {_HITS} group by 1, 2)
select target, surface, n from (select *, row_number() over (partition by target order by n desc, surface) as k from s) where k <= 6""")
def a17_top_surfaces(spark: SparkSession, sf: str) -> DataFrame:
    c = _hits(spark, sf).groupBy("target", "surface").agg(F.count("*").alias("n"))
    return stats.top_per_group(c, ["target"], [F.desc("n"), F.col("surface")], 6).select("target", "surface", "n")


_STOP = """
the and for that will was with from who our their after years are but not you all any can had her his him how its may nor now off one out own per say she too two
use via way yet they them then this what when while also been before being both could did does each else ever every few have here into just less like made many
might more most much must near only other over same should since some such than there these those through under until upon very were where which whose why without would your
""".split()
_STOPSQL = ", ".join(f"'{w}'" for w in _STOP)


@R.add(f"""
with w as (select kind, [x for x in list_transform(regexp_extract_all(text, '[a-zA-Z][a-zA-Z'']+'), lambda t: lower(t)) if length(x) >= 3 and x not in ({_STOPSQL})] as ws from documents where text is not null),
b as (select kind, unnest(list_transform(ws[:-2], lambda x, i: x || ' ' || ws[i + 1])) as bigram from w where len(ws) > 1),
c as (select kind, bigram, count(*) as n from b group by 1, 2)
select kind, bigram, n from (select *, row_number() over (partition by kind order by n desc, bigram) as k from c) where k <= 20""")
def n04_bigrams_top(spark: SparkSession, sf: str) -> DataFrame:
    w = _docs(spark, sf).filter("text is not null").select("kind", T.tokens(F.col("text"), 3, _STOP).alias("w"))
    c = w.select("kind", F.explode(T.bigrams(F.col("w"))).alias("bigram")).groupBy("kind", "bigram").agg(F.count("*").alias("n"))
    return stats.top_per_group(c, ["kind"], [F.desc("n"), F.col("bigram")], 20).select("kind", "bigram", "n")


@R.add(f"""
with d as (select year(l) as doc, doc_id, regexp_replace(text, 'https?://[^ \\t\\n\\r\\f\\v]+', '', 'g') as text from {_L} where text is not null),
big as (select doc from d group by 1 having count(*) >= 5),
w as (select doc, doc_id, [x for x in list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z'']{{2,}}'), lambda t: lower(t)) if x not in ({_STOPSQL})] as ws from d where doc in (select doc from big)),
all_w as (select doc, list_reduce(list(ws order by doc_id), lambda a, b: list_concat(a, b)) as ws from w group by 1),
t as (select doc, unnest(ws) as term from all_w union all select doc, unnest(list_transform(ws[:-2], lambda x, i: x || ' ' || ws[i + 1])) from all_w where len(ws) > 1),
tf as (select doc, term, count(*) as n from t group by 1, 2), total as (select count(distinct doc) as big_n from tf),
df as (select term, count(*) as df, sum(n) as cf from tf group by 1), v as (select term, df from df, total where df >= 2 and df <= big_n * 0.85 order by cf desc, term limit 80000),
x as (select tf.doc, tf.term, n, (1 + ln(n)) * (ln((1 + big_n)::double / (1 + df)) + 1) as w from tf join v using (term), total),
s as (select doc, term, n, round(w / sqrt(sum(w * w) over (partition by doc)), 6) as score from x)
select doc, term, n, score, rank from (select *, row_number() over (partition by doc order by score desc, term) as rank from s) where rank <= 15 and score > 0""")
def n05_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """The most distinctive terms of each local year."""
    d = _local_docs(spark, sf).filter("text is not null").select(F.substring("month", 1, 4).cast("int").alias("doc"), "doc_id", "text")
    return terms.tfidf(d, "doc", "text", "doc_id", stop=_STOP, least_rows=5, word="([A-Za-z][A-Za-z']{2,})")


# ---------------------------------------------------------------- vectors

_CSQL = """c as (select label, list(a order by pos) as m from (select label, pos, avg(x) as a from (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings) group by 1, 2) group by 1),
n as (select label, list_transform(m, lambda x: x / (sqrt(list_dot_product(m, m)) + 1e-9)) as c from c),
v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
s as (select v.vec_id, n.label, round(list_dot_product(v.e, n.c) / sqrt(list_dot_product(v.e, v.e)), 6) as score from v, n),
k as (select *, row_number() over (partition by vec_id order by score desc, label) as rank from s where score >= 0.25),
a as (select vec_id, label::varchar as label, score, rank from k where rank <= 3 union all select vec_id, 'general', 0.0, 1 from v where vec_id not in (select vec_id from k))"""


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return vectors.assign_labels(vectors.similarities(e, "vec_id", "embedding", vectors.centroids(e, "label", "embedding")), "vec_id")


@R.add(f"with {_CSQL} select vec_id, label, score, rank from a")
def theme_multilabel(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select("vec_id", "label", "score", "rank")


@R.add(f"with {_CSQL} select label, count(*) as n, round(100.0::double * count(*) / sum(count(*)) over (), 4) as share from a where rank = 1 group by 1")
def theme_primary_share(spark: SparkSession, sf: str) -> DataFrame:
    n = _assigned(spark, sf).filter("rank = 1").groupBy("label").agg(F.count("*").alias("n"))
    return n.select("label", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"))


@R.add("""
with v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings), a as (select e from v where vec_id = 0)
select vec_id, round(list_dot_product(v.e, a.e) / sqrt(list_dot_product(v.e, v.e)) / sqrt(list_dot_product(a.e, a.e)), 6) as sim from v, a where vec_id <> 0 order by sim desc, vec_id limit 20""")
def v06_similar_to_one(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 vectors most similar to one anchor."""
    e = table(spark, sf, "embeddings")
    anchor = e.filter("vec_id = 0").select(F.col("embedding").alias("a"))
    s = F.round(vectors.dot(F.col("embedding"), F.col("a")) / vectors.norm(F.col("embedding")) / vectors.norm(F.col("a")), 6)
    return e.filter("vec_id <> 0").join(anchor).select("vec_id", s.alias("sim")).orderBy(F.desc("sim"), "vec_id").limit(20)


@R.add("""select post_id, lower(trim(theme)) as theme, count(*) as n from post_themes where lower(trim(theme)) not in ('harbors', 'schools') group by 1, 2""")
def v07_hide_themes(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "post_themes").select("post_id", F.lower(F.trim("theme")).alias("theme"))
    return t.filter(~F.col("theme").isin("harbors", "schools")).groupBy("post_id", "theme").agg(F.count("*").alias("n"))


QUERIES, SQL = R.queries, R.sql
