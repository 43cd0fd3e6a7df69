"""Text expressions, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(text: Column) -> Column:
    return text.isNotNull() & (F.length(text) > 0)


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty (a plain coalesce stops at empty strings)."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def strip(text: Column) -> Column:
    """White space of all kinds off both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """White space runs to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_urls(text: Column) -> Column:
    return F.regexp_replace(text, r"https?://\S+", "")


def strip_html(text: Column) -> Column:
    """Tags to blanks, only in texts that hold both ``<`` and ``>``; entities stay as they are."""
    return F.when(text.contains("<") & text.contains(">"), collapse(F.regexp_replace(text, "<[^>]+>", " "))).otherwise(text)


def escape_html(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def shorten(text: Column, limit: int) -> Column:
    """Texts beyond ``limit`` end in three dots at ``limit`` characters."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit - 3)), F.lit("..."))).otherwise(text)


def tokens(text: Column, least: int = 3, stop: Sequence[str] = ()) -> Column:
    """Lower-case words of letters and apostrophes, at least ``least`` long, without stop words."""
    found = F.transform(F.regexp_extract_all(text, F.lit("([a-zA-Z][a-zA-Z']+)"), F.lit(1)), F.lower)
    kept = F.filter(found, lambda w: F.length(w) >= least)
    return F.filter(kept, lambda w: ~w.isin(list(stop))) if stop else kept


def bigrams(words: Column) -> Column:
    """Adjacent pairs, joined by a blank; none for fewer than two words."""
    n = F.size(words)
    return F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def caps_share(text: Column) -> Column:
    """The share of words of three and more letters that are all capitals; 0 without such words."""
    words = F.filter(F.regexp_extract_all(text, F.lit("([A-Za-z][A-Za-z']+)"), F.lit(1)), lambda w: F.length(w) >= 3)
    return F.when(F.size(words) > 0, F.size(F.filter(words, lambda w: w == F.upper(w))) / F.size(words)).otherwise(0.0)


def exclamation_density(text: Column) -> Column:
    """Exclamation marks per 100 characters."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.replace(text, F.lit("!"), F.lit("")))) / n * 100).otherwise(0.0)


def classify(text: Column, rules: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """The label of the first rule (pattern, label) that is found in ``text``."""
    out = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), label).otherwise(out)
    return F.coalesce(out, F.lit(default))


def surrogate_id(prefix: str, *parts: Column) -> Column:
    """``prefix`` and the first 16 hex digits of the SHA-1 of the parts."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat(*[F.coalesce(p, F.lit("")) for p in parts])), 1, 16))


def url_id(url: Column, prefix: str) -> Column:
    """The number of a status URL behind ``prefix``; null where there is none."""
    got = F.regexp_extract(url, r"/status/(\d+)", 1)
    return F.when(got != "", F.concat(F.lit(prefix), got))
