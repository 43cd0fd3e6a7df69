"""Further joins, samples and page readers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.functions import text as T
from corpusloom.operators import vectors
from corpusloom.plans.analytics import _HITS, _hits
from corpusloom.plans.registry import Registry
from corpusloom.session import table
from corpusloom.sources import readers

R = Registry()


@R.add(f"""select doc_id, lang from documents where doc_id in (select distinct doc_id from {_HITS} where polarity = 'bad')""")
def j08_semi_distinct(spark: SparkSession, sf: str) -> DataFrame:
    bad = _hits(spark, sf).filter("polarity = 'bad'").select("doc_id")
    return table(spark, sf, "documents").select("doc_id", "lang").join(bad, "doc_id", "left_semi")


@R.add("""select v.vec_id, p.account, p.platform from post_vectors v join (select distinct on (id) id, account, platform from posts order by id, row_id) p on p.id = v.post_id where v.label is not null""")
def j11_score_metadata(spark: SparkSession, sf: str) -> DataFrame:
    from corpusloom.operators import upsert

    p = upsert.keep_first(table(spark, sf, "posts").select("id", "account", "platform", "row_id"), ["id"], [F.col("row_id")])
    v = table(spark, sf, "post_vectors").filter("label is not null").select("vec_id", "post_id")
    return v.join(p, F.col("post_id") == F.col("id")).select("vec_id", "account", "platform")


@R.add("""select d.doc_id, s.name from documents d join sources s on s.source_id = d.source where s.name is not null""")
def j13_resolved_only(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "sources").filter("name is not null").select("source_id", "name")
    return table(spark, sf, "documents").join(s, F.col("source") == F.col("source_id")).select("doc_id", "name")


@R.add("""select row_id, id from posts where source_file in (select distinct source_file from posts where file_no = 1)""")
def j16_listed_only(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose file is in a listing."""
    p = table(spark, sf, "posts")
    listing = p.filter("file_no = 1").select("source_file").distinct()
    return p.select("row_id", "id", "source_file").join(listing, "source_file", "left_semi").select("row_id", "id")


@R.add("""select row_id, exists (select 1 from post_vectors v where v.post_id = p.id) as has_vector from posts p""")
def j17_flag(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "post_vectors").select(F.col("post_id").alias("id")).distinct().withColumn("v", F.lit(True))
    return table(spark, sf, "posts").select("row_id", "id").join(v, "id", "left").select("row_id", F.col("v").isNotNull().alias("has_vector"))


@R.add(f"""select target, doc_id from (select target, doc_id, row_number() over (partition by target order by doc_id) as k from (select distinct target, doc_id from {_HITS})) where k <= 5""")
def a17_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Five sample documents of each target, the ones with the smallest ids."""
    h = _hits(spark, sf).select("target", "doc_id").distinct()
    return stats.top_per_group(h, ["target"], [F.col("doc_id")], 5).select("target", "doc_id")


@R.add("""select event_id, round(value, 2) as r2, round(value / 7, 4) as r4 from events""")
def e24_rounding(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.round("value", 2).alias("r2"), F.round(F.col("value") / 7, 4).alias("r4"))


@R.add("""select doc_id from documents where kind = 'post' order by doc_id limit 5000""")
def t04_limit_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """A limit always has an order here."""
    return table(spark, sf, "documents").filter("kind = 'post'").select("doc_id").orderBy("doc_id").limit(5000)


@R.add("""select v.code, count(d.doc_id) as n from (values ('en'), ('de'), ('xx')) v(code) left join documents d on d.lang = v.code group by 1""")
def x06_values(spark: SparkSession, sf: str) -> DataFrame:
    v = spark.createDataFrame([("en",), ("de",), ("xx",)], "code string")
    n = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return v.join(n, F.col("code") == F.col("lang"), "left").select("code", F.coalesce("n", F.lit(0)).alias("n"))


@R.add("""
with v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings), a as (select e from v where vec_id = 1),
s as (select round(list_dot_product(v.e, a.e) / sqrt(list_dot_product(v.e, v.e)) / sqrt(list_dot_product(a.e, a.e)), 6) as s from v, a),
h as (select least(greatest(s, 0), 1) as s from s)
select least(floor(s * 20), 19)::bigint as bin, count(*) as n from h group by 1""")
def v05_anchor_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Similarities to one anchor vector in 20 bins."""
    e = table(spark, sf, "embeddings")
    a = e.filter("vec_id = 1").select(F.col("embedding").alias("a"))
    s = F.round(vectors.dot(F.col("embedding"), F.col("a")) / vectors.norm(F.col("embedding")) / vectors.norm(F.col("a")), 6)
    h = e.join(a).select(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)).alias("s"))
    return h.groupBy(F.least(F.floor(F.col("s") * 20), F.lit(19)).alias("bin")).agg(F.count("*").alias("n"))


@R.add(r"""
with w as (select row_id, regexp_extract_all(lower(coalesce(title, '')), '[a-z][a-z'']+') as ws from speeches)
select row_id, coalesce(array_to_string(case when len(ws) > 1 then list_transform(ws[:-2], lambda x, i: x || ' ' || ws[i + 1]) else [] end, ','), '') as pairs from w""")
def w07_adjacent_pairs(spark: SparkSession, sf: str) -> DataFrame:
    ws = T.tokens(F.coalesce("title", F.lit("")), 1)
    return table(spark, sf, "speeches").select("row_id", F.array_join(T.bigrams(ws), ",").alias("pairs"))


@R.add(r"""select row_id, coalesce(regexp_replace(title, '[<>&"\\]', '', 'g'), '') as body, coalesce(event_date, '') as date from speeches""")
def s04_json_ld(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose text and date stand in JSON-LD, as an object or a list."""
    clean = F.coalesce(F.regexp_replace("title", r'[<>&"\\]', ""), F.lit(""))
    doc = F.to_json(F.struct(clean.alias("articleBody"), F.coalesce("event_date", F.lit("")).alias("dateCreated")))
    ld = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit("["), doc, F.lit("]"))).otherwise(doc)
    page = F.concat(F.lit('<html><script type="application/ld+json">'), ld, F.lit("</script></html>"))
    s = table(spark, sf, "speeches").select("row_id", page.alias("html"))
    p = readers.html_article(F.col("html"))
    return s.select("row_id", F.coalesce(p["body"], F.lit("")).alias("body"), F.coalesce(p["date"], F.lit("")).alias("date"))


@R.add(r"""
with i as (select id, coalesce(account, '') as who, coalesce(trim(regexp_replace(regexp_replace(text, '[<>]', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' '), '') as content, row_id from posts)
select id, who, md5(content) as content from i""")
def s05_timeline_items(spark: SparkSession, sf: str) -> DataFrame:
    """Landed timeline pages (one a file of a feed), an item by its classes."""
    plain = T.collapse(F.regexp_replace(F.coalesce("text", F.lit("")), "[<>]", ""))
    block = F.concat(F.lit('<div class="timeline-item"><a class="username">'), F.coalesce("account", F.lit("")), F.lit('</a><p class="key">'), "id", F.lit('</p><div class="tweet-content media-body">'), plain, F.lit("</div></div>"))
    page = table(spark, sf, "posts").groupBy("feed", "file_no").agg(F.array_join(F.collect_list(block), "\n").alias("html"))
    got = readers.class_items(page, "html", "timeline-item", {"who": "username", "id": "key", "content": "tweet-content"})
    return got.select("id", "who", F.md5("content").alias("content"))


QUERIES, SQL = R.queries, R.sql
