"""Distinctive terms (TF-IDF by period)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.ordered import previous
from corpusloom.session import materialise


def tfidf(df: DataFrame, doc: str, text: str, order: str, stop: list[str] = (), least_rows: int = 1, max_share: float = 0.85, min_df: int = 2, max_terms: int = 80_000, top: int = 15, word: str = r"\b([A-Za-z][A-Za-z']{2,})\b") -> DataFrame:
    """(doc, term, n, score, rank): the ``top`` terms of each document by smoothed, sublinear TF-IDF.

    A document is all rows of a ``doc`` value in ``order``; bigrams run across rows.  Only the
    first and last word of each row are brought in order, so no document is ever gathered or concatenated.  Terms are kept if ``min_df`` documents and at most ``max_share`` of all have
    them, and of these the ``max_terms`` most frequent.  Weights are (1 + ln tf) (ln((1 + N) / (1 + df)) + 1),
    scaled to length 1 per document; ties go to the smaller term.
    """
    words = F.filter(F.transform(F.regexp_extract_all(T.without_urls(F.col(text)), F.lit(word), F.lit(1)), F.lower), lambda w: ~w.isin(list(stop)) if stop else F.lit(True))
    sized = df.groupBy(F.col(doc).alias("doc")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= least_rows).select("doc")
    rows = df.select(F.col(doc).alias("doc"), F.col(order).alias("o"), words.alias("w")).join(sized, "doc", "left_semi").filter(F.size("w") > 0)
    inner = rows.select("doc", F.explode(F.concat("w", T.bigrams(F.col("w")))).alias("term"))
    # Across rows only the first and last word of each are needed, in order.
    ends = materialise(rows.select("doc", "o", F.col("w")[0].alias("first"), F.element_at("w", -1).alias("last")))
    across = previous(ends, "doc", "o", "last", "before").filter("before is not null").select("doc", F.concat_ws(" ", "before", "first").alias("term"))
    terms = inner.unionByName(across)
    tf = terms.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("n"))
    total = tf.agg(F.countDistinct("doc").alias("n_doc"))
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("cf")).join(total).filter((F.col("df") >= min_df) & (F.col("df") <= F.col("n_doc") * max_share))
    vocabulary = df_.orderBy(F.desc("cf"), "term").limit(max_terms)
    weight = (1 + F.log(F.col("n").cast("double"))) * (F.log((1 + F.col("n_doc")) / (1 + F.col("df"))) + 1)
    w = tf.join(vocabulary, "term").withColumn("w", weight)
    length = w.groupBy("doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    scored = w.join(length, "doc").withColumn("score", F.round(F.col("w") / F.col("length"), 6))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("score"), "term")))
    return ranked.filter((F.col("rank") <= top) & (F.col("score") > 0)).select("doc", "term", "n", "score", "rank")
