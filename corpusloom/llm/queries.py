"""Queries of the llm data problems over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import leaks, mojibake, neardup, neighbours, tokens, topn
from corpusloom.session import table

# Unicode white space, so that blanks of every kind around a slug fall.
_BLANK = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of post vectors of which one is among the 5 nearest of the other."""
    got = neighbours.nearest(table(spark, sf, "post_vectors"), "vec_id", "embedding", 128, k=5, least=0.8)
    return got.select(F.least("id", "neighbour").alias("vec_a"), F.greatest("id", "neighbour").alias("vec_b")).distinct()


def p1_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves of a sixteenth of the vectors, where that is less than usual, so that any data make a tree: does it have
    several leaves, and does the search find 0.98 of what brute force finds?"""
    v = table(spark, sf, "post_vectors")
    leaves, recall = neighbours.measured(v, "vec_id", "embedding", 128, k=5, least=0.8, leaf=min(2048, max(16, v.count() // 16)))
    return spark.createDataFrame([(leaves > 1, recall >= 0.98)], "several_leaves boolean, recall_reached boolean")


def _near(spark: SparkSession, sf: str) -> neardup.NearDuplicates:
    posts = table(spark, sf, "posts").select(F.lit("posts").alias("scope"), "id", "text")
    speeches = table(spark, sf, "speeches").select(F.lit("speeches").alias("scope"), "id", "text")
    return neardup.find(posts.unionByName(speeches), F.col("scope"), F.col("id"), F.col("text"), t=0.6, shingle=2, min_words=10)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of posts and pairs of speeches whose texts share 0.6 of their pairs of adjacent words."""
    return neardup.pairs(_near(spark, sf)).select(F.col("scope").alias("source_table"), F.col("key_a").alias("id_a"), F.col("key_b").alias("id_b"))


def p5_classes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per post or speech: its class of equal sets of word pairs and how many other classes are near."""
    got = neardup.classes(_near(spark, sf))
    return got.select(F.col("scope").alias("source_table"), F.col("key").alias("id"), F.col("class").alias("class_id"), "n_links")


def p5_links(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs of classes that are near each other."""
    return neardup.class_links(_near(spark, sf)).withColumnRenamed("scope", "source_table")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """The 10 best posts of every theme."""
    theme = F.lower(F.regexp_replace("theme", _BLANK, ""))
    got = topn.top_n(table(spark, sf, "post_themes"), theme, F.col("post_id"), F.col("score"), 10)
    return got.select(F.col("group").alias("theme"), F.col("item").alias("post_id"))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.encode_corpus(table(spark, sf, "documents"), "doc_id", "text")


def p7_tree(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents take the tree, and their pieces that are joined in it."""
    joined = tokens.pieces(table(spark, sf, "documents"), "doc_id", "text").filter("_n > 1")
    return joined.agg(F.countDistinct("_row").alias("n_docs"), F.count(F.lit(1)).alias("n_pieces"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that share 12 consecutive words with an evaluation item."""
    return leaks.find_leaks(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "eval_items"), "item_id", "text")


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents each leaked item stands in."""
    return p8_found(spark, sf).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents decoded with a wrong encoding, with the MD5 of the restored text ('' if lost)."""
    got = mojibake.restore(table(spark, sf, "documents"), "doc_id", "text")
    return got.select("doc_id", F.when(F.col("lost"), "").otherwise(F.md5("restored")).alias("restored_md5"))


def p9_chains(spark: SparkSession, sf: str) -> DataFrame:
    """The encoding chains that the corpus proves, with the number of words under each."""
    subs = mojibake.substitutions(table(spark, sf, "documents"), "text")
    return subs.groupBy("chain").agg(F.count(F.lit(1)).alias("n_words"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_recall": p1_recall, "p5_found": p5_found, "p5_classes": p5_classes, "p5_links": p5_links, "p6_found": p6_found, "p7_ids": p7_ids, "p7_tree": p7_tree, "p8_found": p8_found, "p8_items": p8_items, "p9_found": p9_found, "p9_chains": p9_chains}
_P8 = r"""
with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where text is not null),
i as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from eval_items where text is not null),
dr as (select distinct doc_id, array_to_string(w[k:k + 11], ' ') as run from (select doc_id, w, unnest(generate_series(1, len(w) - 11)) as k from d where len(w) >= 12)),
ir as (select distinct item_id, array_to_string(w[k:k + 11], ' ') as run from (select item_id, w, unnest(generate_series(1, len(w) - 11)) as k from i where len(w) >= 12))
select distinct doc_id, item_id from dr join ir using (run)"""
_P5 = r"""
with t as (select 'posts' as source_table, id, text from posts where text is not null union select 'speeches', id, text from speeches where text is not null),
w as (select source_table, id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from t),
s as (select distinct source_table, id, list_sort(list_distinct(list_transform(w[:-2], lambda x, i: x || ' ' || w[i + 1]))) as k from w where len(w) >= 10),
c as (select source_table, k, min(id) as rep from s group by all),
g as (select source_table, rep, len(k) as n, unnest(k) as g from c),
l as (select a.source_table, a.rep as class_a, b.rep as class_b, count(*)::int as shared from g a join g b on a.source_table = b.source_table and a.g = b.g and a.rep < b.rep group by a.source_table, a.rep, b.rep, a.n, b.n having count(*) >= 0.6 * (a.n + b.n - count(*)) - 1e-9)"""
SQL: dict[str, str] = {
    "p1_recall": "select true as several_leaves, true as recall_reached",
    "p5_links": _P5 + " select * from l",
    "p5_classes": _P5
    + """, e as (select source_table, rep, count(*) as n_links from (select source_table, class_a as rep from l union all select source_table, class_b from l) group by all)
select s.source_table, s.id, c.rep as class_id, coalesce(e.n_links, 0) as n_links from s join c using (source_table, k) left join e on e.source_table = c.source_table and e.rep = c.rep""",
    "p1_found": """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from post_vectors where embedding is not null and len(embedding) = 128),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v where list_dot_product(e, e) > 0),
s as (select a.vec_id as a, b.vec_id as b, round(list_dot_product(a.e, b.e) / (a.n * b.n), 6) as sim from u a join u b on a.vec_id <> b.vec_id),
k as (select a, b, row_number() over (partition by a order by sim desc, b) as r from s where sim >= 0.8)
select distinct least(a, b) as vec_a, greatest(a, b) as vec_b from k where r <= 5""",
    "p5_found": r"""
with t as (select 'posts' as source_table, id, text from posts where text is not null union select 'speeches', id, text from speeches where text is not null),
w as (select source_table, id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from t),
g as (select distinct source_table, id, unnest(list_transform(w[:-2], lambda x, i: x || ' ' || w[i + 1])) as g from w where len(w) >= 10),
n as (select source_table, id, count(*) as n from g group by all),
o as (select a.source_table, a.id as id_a, b.id as id_b, count(*) as o from g a join g b on a.source_table = b.source_table and a.g = b.g and a.id < b.id group by all)
select o.source_table, id_a, id_b from o join n x on x.source_table = o.source_table and x.id = id_a join n y on y.source_table = o.source_table and y.id = id_b where o >= 0.6 * (x.n + y.n - o) - 1e-9""",
    "p8_found": _P8,
    "p8_items": f"select item_id, count(distinct doc_id) as n_docs from ({_P8}) group by 1",
    "p7_tree": r"""
with d as (select doc_id, text from documents where length(text) > 100000 or regexp_matches(text, '[^ \t\n\r]{513}|[ \t\n\r]{513}')),
s as (select doc_id, unnest(list_transform(regexp_extract_all(text, '[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+'), lambda x: length(x))) as n from d)
select count(distinct doc_id) as n_docs, coalesce(sum(power(2, ceil(log2(n / 512.0)))), 0)::bigint as n_pieces from s where n > 512""",
    "p6_found": """
with best as (
  select lower(trim(theme)) as theme, post_id, max(score) as score
  from post_themes where score is not null and not isnan(score) and theme is not null and post_id is not null group by 1, 2),
ranked as (select theme, post_id, row_number() over (partition by theme order by score desc, post_id) as k from best)
select theme, post_id from ranked where k <= 10""",
}
