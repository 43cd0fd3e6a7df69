"""Readers of landed files: CSV, JSON documents, header-first arrays, HTML pages, delimited text."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom.functions import text as T


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose names may be padded; nulls become ''.

    Fields beyond the header are joined to the last column with ``,``, as unquoted commas of
    a last text column are.  Quoted fields may hold line breaks.
    A row's fields have no fixed number; more than a million raise an error.
    """
    head = spark.read.csv(path, header=True, multiLine=True, escape='"')
    names = [c.strip() for c in head.columns]
    # Rows with more or fewer fields than the header come whole beside their columns.
    schema = ", ".join(f"`{n}` string" for n in [*names, "_raw"])
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', schema=schema, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_raw", maxColumns=1_000_000)
    rows = rows.withColumn("_fields", _fields("_raw"))
    field = lambda i: F.when(F.col("_raw").isNull(), F.col(f"`{names[i]}`")).otherwise(F.get("_fields", F.lit(i)))
    n = len(names) - 1
    last = F.when(F.col("_raw").isNull(), F.col(f"`{names[n]}`")).otherwise(F.array_join(F.slice("_fields", F.lit(n + 1), F.greatest(F.size("_fields") - n, F.lit(0))), ","))
    return rows.select(*[F.coalesce(field(i), F.lit("")).alias(names[i]) for i in range(n)], F.coalesce(last, F.lit("")).alias(names[n]))


@F.udf(ArrayType(StringType()), useArrow=True)
def _fields(record: str | None) -> list[str] | None:
    """The fields of one CSV record, however many."""
    if record is None:
        return None
    csv.field_size_limit(2**31 - 1)
    return next(csv.reader(io.StringIO(record, newline="")), [])


# The names under which documents wrap their list of records.
WRAPPERS = ("data", "truths", "posts", "records")


def json_records(spark: SparkSession, path: str, schema: str, wrappers: tuple[str, ...] = WRAPPERS) -> DataFrame:
    """Records of JSON documents that are a list or an object with a list under one of ``wrappers``.

    A document that has neither raises an error, as its records would be lost silently.
    """
    docs = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    lists = F.coalesce(*[F.try_variant_get(v, p, f"array<{schema}>") for p in ("$", *(f"$.{w}" for w in wrappers))])
    checked = F.when(lists.isNull(), F.raise_error(F.lit("no list of records in the document"))).otherwise(lists)
    return docs.select(F.explode(checked).alias("r")).select("r.*")


def header_first_array(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows of a JSON array of arrays whose first row names the columns, located by name."""
    rows = F.from_json(F.col(text), "array<array<string>>")
    each = df.select(rows.alias("t")).filter(F.size("t") > 1).select(F.element_at("t", 1).alias("h"), F.explode(F.slice("t", F.lit(2), F.size("t") - 1)).alias("r"))
    return each.select(*[F.get("r", F.array_position("h", c).cast("int") - 1).alias(c) for c in columns])


def html_article(html: Column) -> dict[str, Column]:
    """Title, date and body of a page: JSON-LD first, then metadata, then elements."""
    ld = F.regexp_extract(html, r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1)
    one = F.coalesce(F.get_json_object(ld, "$[0]"), ld)
    meta = lambda name: F.regexp_extract(html, rf'(?is)<meta[^>]*(?:property|name)="{name}"[^>]*content="([^"]*)"', 1)
    tag = lambda name: T.strip_html(F.regexp_extract(html, rf"(?is)(<{name}[^>]*>.*?</{name}>)", 1))
    field = lambda *names: [F.get_json_object(one, f"$.{n}") for n in names]
    return {
        "title": T.first_filled(tag("h1"), meta("og:title"), tag("title")),
        "date": T.first_filled(*field("datePublished", "dateCreated"), meta("article:published_time"), F.regexp_extract(html, r'(?is)<time[^>]*datetime="([^"]*)"', 1)),
        "body": T.first_filled(*field("articleBody", "text", "description"), meta("og:description"), tag("article"), tag("p")),
    }


def delimited_speeches(df: DataFrame, text: str, marker: str = "SPEECH ") -> DataFrame:
    """(title, body, no) of records that start at lines with ``marker``, in any case.

    What stands before the first marker is dropped, as are records without a body.
    """
    parts = F.split(F.col(text), rf"(?im)^\s*{marker}")
    each = df.select("*", F.posexplode(parts).alias("no", "_p")).filter("no > 0")
    out = each.withColumn("title", T.strip(F.regexp_extract("_p", r"^([^\n]*)", 1))).withColumn("body", T.strip(F.regexp_replace("_p", r"^[^\n]*\n?", "")))
    return out.filter("body <> ''").drop("_p")


def _contains(needle: str) -> Callable[[Column], Column]:
    return lambda c: F.lower(c).contains(needle)


def html_table(df: DataFrame, html: str, columns: dict[str, str], row: str | None = None) -> DataFrame:
    """Cells of HTML tables as columns, located by a part of their header cell (lower case).

    ``row``: a further column with all cells of the row, for what its column doesn't hold.
    """
    cells = lambda row: F.transform(F.regexp_extract_all(row, F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1)), lambda c: T.collapse(F.regexp_replace(c, "<[^>]+>", " ")))
    rows = F.transform(F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<tr.*?</tr>)"), F.lit(1)), cells)
    t = df.withColumn("_rows", rows)
    needles = list(columns.values())
    is_head = lambda r: F.exists(r, lambda c: F.lower(c).contains(needles[0]))
    t = t.withColumn("_head", F.get(F.filter("_rows", is_head), F.lit(0)))
    at = {n: F.array_position(F.transform("_head", _contains(w)), True) for n, w in columns.items()}
    each = t.withColumns({f"_at_{n}": p for n, p in at.items()}).select("*", F.explode("_rows").alias("_r")).filter(~F.col("_r").eqNullSafe(F.col("_head")) & F.col("_head").isNotNull())
    whole = [F.array_join("_r", " | ").alias(row)] if row else []
    return each.select(*df.columns, *[F.get("_r", F.col(f"_at_{n}").cast("int") - 1).alias(n) for n in columns], *whole).drop(html)


def month_name_date(*texts: Column) -> Column:
    """The date of the first of ``texts`` that holds one like ``March 5, 2020``; null where none does."""
    named = "(January|February|March|April|May|June|July|August|September|October|November|December)"
    found = lambda t: F.regexp_extract(t, named + r" (\d{1,2}),? (\d{4})", 0)
    return F.coalesce(*[F.try_to_date(F.replace(found(t), F.lit(","), F.lit("")), "MMMM d yyyy") for t in texts])


def links(text: Column) -> Column:
    """All URLs of a text, in order."""
    return F.regexp_extract_all(text, F.lit(r"(https?://[^\s\"'<>]+)"), F.lit(1))


def two_stage_lookup(df: DataFrame, key: Column, first: DataFrame, second: DataFrame, value: str) -> DataFrame:
    """``value`` from ``first`` (k, value), else from ``second``; null where neither has the key."""
    a = first.select(F.col("k").alias("_k1"), F.col(value).alias("_v1"))
    b = second.select(F.col("k").alias("_k2"), F.col(value).alias("_v2"))
    j = df.withColumn("_key", key).join(a, F.col("_key") == F.col("_k1"), "left").join(b, F.col("_key") == F.col("_k2"), "left")
    return j.withColumn(value, F.coalesce("_v1", "_v2")).drop("_key", "_k1", "_k2", "_v1", "_v2")


def cached_lookup(keys: DataFrame, cache: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Look up ``keys`` (k) in ``cache`` (k, v), the missing ones only in ``source`` (k, v).

    Gives (k, v, cached) and the grown cache, which holds keys that ``source`` lacks as well, with null, so that they
    aren't looked up again.
    """
    known = keys.join(cache.select("k", "v", F.lit(True).alias("cached")), "k", "left")
    hits = known.filter("cached").select("k", "v", "cached")
    asked = known.filter("cached is null").select("k").join(source.select("k", "v"), "k", "left")
    found = hits.unionByName(asked.withColumn("cached", F.lit(False)))
    return found, cache.select("k", "v").unionByName(asked)


def split_intervals(df: DataFrame, start: str, end: str, longest: float, shortest: float) -> DataFrame:
    """Intervals cut into pieces of at most ``longest``; pieces below ``shortest`` are dropped."""
    n = F.ceil((F.col(end) - F.col(start)) / longest).cast("int")
    each = df.filter(F.col(end) > F.col(start)).select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    each = each.withColumn("piece_start", F.col(start) + F.col("piece") * longest).withColumn("piece_end", F.least(F.col(start) + (F.col("piece") + 1) * longest, F.col(end)))
    return each.filter(F.col("piece_end") - F.col("piece_start") >= shortest)


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256) of raw files."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def class_items(df: DataFrame, html: str, item: str, fields: dict[str, str]) -> DataFrame:
    """One row for each element of class ``item`` of a page, its parts located by their classes.

    An item reaches to the next one; a part's text is that of the first element with its class.
    """
    parts = F.split(F.col(html), rf'<[a-z]+[^>]*class="{item}(?: [^"]*)?"[^>]*>')
    blocks = F.slice(parts, F.lit(2), F.size(parts) - 1)
    each = df.filter(F.col(html).isNotNull()).select("*", F.posexplode(blocks).alias("item_no", "_b"))
    part = lambda c: T.strip_html(F.regexp_extract("_b", rf'(?is)(<([a-z]+)[^>]*class="{c}(?: [^"]*)?"[^>]*>.*?</\2>)', 1))
    return each.select(*[c for c in df.columns if c != html], "item_no", *[part(c).alias(n) for n, c in fields.items()])
