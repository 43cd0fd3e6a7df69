"""Mixed timestamp writings and time zones as one unambiguous instant.

Each value is matched against a catalog of writings, each with one or more readings
(``03/04/2018`` reads as month first or day first, ``1443785823`` as seconds or milliseconds).  A
reading is possible where it parses to a real time.  Which reading a source means is estimated by
expectation-maximisation over the mixture of readings of that source.  A value contributes its likelihood
under each valid parse: nothing where it is no real time, else the share of the parse's decade among
the values that have one reading only (in ``03/04/2018`` both parses have one decade, which decides nothing).
The sufficient statistics of a value are its writing, the set of its possible readings and, for numbers, their
decades, so values are first counted by these and by source with map-side combine, and the iterations run on these
few counts, never on rows.

1. All sources together are fitted first, for each writing.
2. Each source starts from that mixture, weighted as ``strength`` values, so that a source without evidence of
   its own follows the others and one with evidence its own.
3. The posterior chooses; values below ``min_posterior``, or under a reading that fewer than ``min_weight`` of the
   source's values of the writing follow (an error rather than a habit), are marked unresolved.

``beliefs`` says which reading of a writing is expected before any evidence, as a prior of ``strength`` values;
``conventions`` fixes the reading of a writing (prior 1, all others 0).

Defined results: null, blank, unreadable and impossible values have status ``unreadable``
and a null instant; blanks around a value don't count; a zone column that is null or names
no zone means UTC; a wall time that occurs twice is the first and has status ``ambiguous_fold``, a skipped one
moves on by the gap and has status ``skipped``; repeated rows are kept; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import materialise

# Zone abbreviations and their offsets in minutes.
ABBREVIATIONS = {
    "GMT": 0, "UTC": 0, "Z": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "CET": 60, "CEST": 120,
}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_FULL = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

_MON = "(" + "|".join([*_FULL, *MONTHS, "sept"]) + r")\.?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?:\s*([ap])\.?m\.?(?![a-z]))?"
_ZONE = r"(?:\s*(z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[a-z]{3,4}|[a-z]+(?:/[a-z0-9_+-]+)+))?"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"

#: writing -> (pattern over the lower-cased value, the groups of year, month, day, hour, minute,
#: second, fraction, half of day, zone for each reading; 0: not written)
WRITINGS: dict[str, tuple[str, dict[str, tuple[int, ...]]]] = {
    "iso": (r"(\d{4})-(\d{2})-(\d{2})(?:[t\s]\s*" + _CLOCK + _ZONE + ")?", {"ymd": (1, 2, 3, 4, 5, 6, 7, 8, 9)}),
    "compact": (r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})", {"ymd": (1, 2, 3, 4, 5, 6, 0, 0, 0)}),
    "compact_t": (r"(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(\d{2})?(?:[.,](\d{1,9}))?" + _ZONE, {"ymd": (1, 2, 3, 4, 5, 6, 7, 0, 8)}),
    "slashed": (r"(\d{1,2})/(\d{1,2})/(\d{4})(?:,?\s+" + _CLOCK + _ZONE + ")?", {"mdy": (3, 1, 2, 4, 5, 6, 7, 8, 9), "dmy": (3, 2, 1, 4, 5, 6, 7, 8, 9)}),
    "slashed_ymd": (r"(\d{4})/(\d{1,2})/(\d{1,2})(?:,?\s+" + _CLOCK + _ZONE + ")?", {"ymd": (1, 2, 3, 4, 5, 6, 7, 8, 9)}),
    "dotted": (r"(\d{1,2})\.(\d{1,2})\.(\d{4})(?:,?\s+" + _CLOCK + _ZONE + ")?", {"dmy": (3, 2, 1, 4, 5, 6, 7, 8, 9), "mdy": (3, 1, 2, 4, 5, 6, 7, 8, 9)}),
    "month_day": (_WEEKDAY + _MON + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?:,?\s*(?:·|-|at)?\s*" + _CLOCK + _ZONE + ")?", {"mdy": (3, 1, 2, 4, 5, 6, 7, 8, 9)}),
    "day_month": (_WEEKDAY + r"(\d{1,2})(?:st|nd|rd|th)?\s+" + _MON + r",?\s+(\d{4})(?:,?\s*(?:·|-|at)?\s*" + _CLOCK + _ZONE + ")?", {"dmy": (3, 2, 1, 4, 5, 6, 7, 8, 9)}),
    "ctime": (_WEEKDAY + _MON + r"\s+(\d{1,2})\s+" + _CLOCK + _ZONE + r"\s+(\d{4})", {"mdy": (9, 1, 2, 3, 4, 5, 6, 7, 8)}),
}
#: Writings with a second reading, which swaps month and day.
SEVERAL = [w for w, (_, readings) in WRITINGS.items() if len(readings) > 1]
#: Numbers since 1970 of up to 10 and of up to 13 digits.
NUMBERS = ["number", "long_number"]
#: Slashed dates put the month first, dotted ones the day; numbers count seconds up to 10 digits, else milliseconds.
STATED = {"slashed": "mdy", "dotted": "dmy", "number": "s", "long_number": "ms"}
#: Numbers that would lie behind this instant (2200-01-01) are no times.
_LATEST = 7_258_118_400_000_000


def zone_names(spark: SparkSession) -> list[str]:
    """The zone names that the JVM's zone rules know (about 600, whatever the data)."""
    return sorted(str(x) for x in spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds().toArray())


def _number(x: Column) -> Column:
    return F.when(x == "", F.lit(0)).otherwise(x.try_cast("int"))


def _instant(p: list[Column], place: Column, offset: Column) -> Column:
    """Microseconds since 1970 of the parts ``p`` (year, month, day, hour, minute, second, fraction,
    half of day, as strings, '' where not written) at ``offset`` minutes from the clock of the zone
    ``place``; null where no such time exists."""
    year, month, day, hour, minute, second, fraction, half = p
    name = F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(month, 1, 3)).cast("int")
    number = F.when(name > 0, name).otherwise(month.try_cast("int"))
    clock = F.when(half == "", _number(hour)).when(_number(hour).between(1, 12), _number(hour) % 12 + F.when(half == "p", 12).otherwise(0))
    sec = F.when(_number(second) < 60, _number(second)).cast("decimal(16,6)")
    micros = F.when(fraction == "", F.lit(0)).otherwise(F.rpad(F.substring(fraction, 1, 6), 6, "0").try_cast("int"))
    at = F.unix_micros(F.try_make_timestamp(_number(year), number, _number(day), clock, _number(minute), sec, place))
    return at + micros - offset.cast("long") * 60_000_000


def _offset(zone: Column, name: Column) -> Column:
    """Minutes to take off for the zone as written: 0 for none or a name, null for no known zone."""
    abbreviation = F.lit(None).cast("int")
    for k, v in ABBREVIATIONS.items():
        abbreviation = F.when(zone == k.lower(), v).otherwise(abbreviation)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours, minutes = F.substring(digits, 1, 2).try_cast("int"), F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    away = hours * 60 + minutes
    signed = F.when((minutes < 60) & (away <= 18 * 60), F.when(zone.startswith("-"), -away).otherwise(away))
    return F.when(zone == "", 0).when(zone.rlike("^[+-]"), signed).otherwise(F.coalesce(abbreviation, F.when(name.isNotNull(), 0)))


_PARTS = ["year", "month", "day", "hour", "minute", "second", "fraction", "half", "zone"]


def with_readings(df: DataFrame, value: str, zone: str | None) -> DataFrame:
    """Add ``_writing`` (null: none known), ``_at``: an array with the instant of each reading of that writing, null
    where the reading is impossible, and ``_marks``: for each, 1 if its wall time occurs twice, 2 if it is skipped, else 0."""
    known = zone_names(df.sparkSession)
    # The value is trimmed of all Unicode white space and lower-cased once.
    trimmed = F.lower(F.regexp_replace(F.col(value), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    home = F.when(F.col(zone).isin(known), F.col(zone)) if zone else F.lit(None).cast("string")
    df = df.withColumns({"_v": trimmed, "_home": home})
    v = F.col("_v")
    writing = F.when(v.rlike(r"^[0-9]{1,13}$") & ~v.rlike(r"^[0-9]{4}$"), F.when(F.length(v) <= 10, NUMBERS[0]).otherwise(NUMBERS[1]))
    for name, (pattern, _) in WRITINGS.items():
        writing = writing.when(v.rlike(f"^{pattern}$"), F.lit(name))
    df = df.withColumn("_writing", writing)
    # Each writing is brought to one line of parts, in the order of its first reading.
    line = F.lit(None).cast("string")
    for name, (pattern, readings) in WRITINGS.items():
        groups = next(iter(readings.values()))
        line = F.when(F.col("_writing") == name, F.regexp_replace(v, f"^{pattern}$", "|".join(f"${g}" if g else "" for g in groups))).otherwise(line)
    df = df.withColumn("_parts", F.split(line, r"\|", -1))
    df = df.withColumns({f"_{n}": F.get("_parts", F.lit(i)) for i, n in enumerate(_PARTS)})
    # A zone name, in any case; abbreviations go first, as some of them name zones with other rules.
    zone_col = F.col("_zone")
    short = zone_col.isin([k.lower() for k in ABBREVIATIONS])
    at_name = F.array_position(F.lit([z.lower() for z in known]), zone_col).cast("int")
    df = df.withColumn("_name", F.when((zone_col != "") & ~short & zone_col.rlike("^[a-z]"), F.get(F.lit(known), F.nullif(at_name, F.lit(0)) - 1)))
    place = F.when(zone_col == "", F.coalesce("_home", F.lit("UTC"))).otherwise(F.coalesce("_name", F.lit("UTC")))
    df = df.withColumns({"_place": place, "_offset": _offset(zone_col, F.col("_name"))})
    parts = [F.col(f"_{n}") for n in _PARTS[:-1]]
    first = _instant(parts, F.col("_place"), F.col("_offset"))
    swapped = F.when(F.col("_writing").isin(SEVERAL), _instant([parts[0], parts[2], parts[1], *parts[3:]], F.col("_place"), F.col("_offset")))
    swapped_parts = [parts[0], parts[2], parts[1], *parts[3:]]
    df = df.withColumns({"_at_0": first, "_at_1": swapped})
    utc, none = F.lit("UTC"), F.lit(0)
    marks = [_mark(F.col("_at_0"), _instant(parts, utc, none), F.col("_place")), F.when(F.col("_at_1").isNotNull(), _mark(F.col("_at_1"), _instant(swapped_parts, utc, none), F.col("_place")))]
    number = v.try_cast("long")
    timed = lambda unit: F.when(number * unit < _LATEST, number * unit)
    is_number = F.col("_writing").isin(NUMBERS)
    at = F.when(is_number, F.array(timed(1_000_000), timed(1_000))).when(F.col("_writing").isin(SEVERAL), F.array("_at_0", "_at_1")).when(F.col("_writing").isNotNull(), F.array("_at_0"))
    df = df.withColumns({"_at": at, "_marks": F.when(~is_number, F.array(*marks))})
    return df.drop("_v", "_home", "_parts", "_at_0", "_at_1", "_name", "_place", "_offset", *[f"_{n}" for n in _PARTS])


def _mark(at: Column, wall: Column, place: Column) -> Column:
    """1 where the wall time (microseconds as if in UTC) of the instant occurs twice in the zone, 2 where it is skipped."""
    ahead = lambda us: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), place)) - us
    now, then = ahead(at), ahead(at + 86_400_000_000)
    twice = (now > then) & (ahead(at + now - then) == then)
    return F.when((place == "UTC") | at.isNull(), 0).when(at + now != wall, 2).when(twice, 1).otherwise(0)


def _readings_of(writing: str) -> list[str]:
    return ["s", "ms"] if writing in NUMBERS else list(WRITINGS[writing][1])


def _likelihoods(part: pd.DataFrame, decades: dict[int, float]) -> np.ndarray:
    """(rows, 2): the likelihood of each row's values under each reading."""
    share = np.array([[decades.get(int(y), decades[-1]) if y >= 0 else 1.0 for y in part[c]] for c in ("decade_0", "decade_1")]).T
    return share * np.stack([part["mask"].to_numpy() & 1, part["mask"].to_numpy() >> 1 & 1], axis=1)


def _em(like: np.ndarray, n: np.ndarray, prior: np.ndarray, rounds: int) -> np.ndarray:
    """The mixture weights; ``prior``: pseudo counts of the readings."""
    weight = prior / prior.sum()
    for _ in range(rounds):
        joint = like * weight
        total = joint.sum(axis=1, keepdims=True)
        share = np.divide(joint, total, out=np.zeros_like(joint), where=total > 0)
        new = prior + (share * n[:, None]).sum(axis=0)
        new /= new.sum()
        if np.abs(new - weight).max() < 1e-9:
            return new
        weight = new
    return weight


def fit(counts: pd.DataFrame, priors: dict[str, list[float]], decades: dict[int, float], rounds: int = 50) -> pd.DataFrame:
    """EM for the ``counts`` (writing, mask, decade_0, decade_1, n) of one source: the chosen reading of each, its
    posterior and the mixture weight of the reading in its writing.  ``priors``: pseudo counts by writing;
    ``decades``: the shares of decades, under -1 that of any other; a decade of -1 decides nothing."""
    out = []
    for writing, part in counts.groupby("writing", sort=True):
        names, like = _readings_of(writing), _likelihoods(part, decades)
        prior = np.array(priors[writing], float)
        weight = _em(like, part["n"].to_numpy(float), prior, rounds)
        joint = like * weight
        for (_, r), j in zip(part.iterrows(), joint, strict=True):
            best, seen = int(j.argmax()), j.sum()
            chosen = (names[best], best, float(j[best] / seen)) if seen > 0 else (None, None, None)
            out.append((writing, int(r["mask"]), int(r["decade_0"]), int(r["decade_1"]), int(r["n"]), *chosen, float(weight[best])))
    return pd.DataFrame(out, columns=["writing", "mask", "decade_0", "decade_1", "n", "reading", "position", "posterior", "weight"])


def _mask() -> Column:
    """The set of possible readings: bit i for reading i (no writing has more than two)."""
    return F.expr("if(get(_at, 0) is null, 0, 1) + if(get(_at, 1) is null, 0, 2)")


def _decade(i: int) -> Column:
    """The decade of reading ``i`` of a number, -1 where it decides nothing."""
    return F.when(F.col("_writing").isin(NUMBERS), F.coalesce(F.floor(F.year(F.timestamp_micros(F.get("_at", F.lit(i)))) / 10).cast("int"), F.lit(-1))).otherwise(-1)


def mixtures(read: DataFrame, source: str, conventions: dict[str, str] | None = None, beliefs: dict[str, str] | None = None, strength: float = 2.0) -> DataFrame:
    """Fit every source: (source, writing, mask, decade_0, decade_1, n, reading, position, posterior, weight).

    A source has as many rows as there are writings, sets of readings and decades of numbers (some tens),
    so a group never grows with the data; what reaches the driver are the counts of all sources together.
    """
    keys = ["writing", "mask", "decade_0", "decade_1"]
    possible = F.size(F.filter("_at", lambda x: x.isNotNull()))
    several = F.col("_writing").isin([*SEVERAL, *NUMBERS])
    plain = read.filter(~several & (possible > 0)).groupBy(F.floor(F.year(F.timestamp_micros(F.get("_at", F.lit(0)))) / 10).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.n for r in plain) + 1.0
    # Of a decade that no plain value has, a hundredth of a value is expected.
    decades = {r.y: r.n / total for r in plain} | {-1: 1.0 / total / 100}
    counts = read.filter(several & (possible > 0)).groupBy(F.col(source).alias("source"), F.col("_writing").alias("writing"), _mask().alias("mask"), _decade(0).alias("decade_0"), _decade(1).alias("decade_1")).agg(F.count(F.lit(1)).alias("n"))
    pooled = counts.groupBy(*keys).agg(F.sum("n").alias("n")).toPandas()
    priors = {}
    for writing in [*SEVERAL, *NUMBERS]:
        names, part = _readings_of(writing), pooled[pooled["writing"] == writing]
        belief, fixed = (beliefs or {}).get(writing), (conventions or {}).get(writing)
        if fixed:
            priors[writing] = [1.0 if r == fixed else 0.0 for r in names]
            continue
        prior = np.array([strength if r == belief else 0.1 for r in names])
        weight = _em(_likelihoods(part, decades), part["n"].to_numpy(float), prior, 50) if len(part) else prior / prior.sum()
        priors[writing] = (strength * weight).tolist()

    def em(pdf: pd.DataFrame) -> pd.DataFrame:
        got = fit(pdf, priors, decades)
        got.insert(0, "source", pdf["source"].iloc[0])
        return got

    return counts.groupBy("source").applyInPandas(em, "source string, writing string, mask int, decade_0 int, decade_1 int, n long, reading string, position int, posterior double, weight double")


def resolve(df: DataFrame, value: str, zone: str | None, source: str, conventions: dict[str, str] | None = None, beliefs: dict[str, str] | None = None, strength: float = 2.0, min_posterior: float = 0.9, min_weight: float = 0.1) -> DataFrame:
    """Add ``utc_us`` (microseconds since 1970 UTC), ``reading``, ``posterior`` and ``status``
    (``resolved``, ``ambiguous_fold``, ``skipped``, ``unresolved``, ``unreadable``) to ``df``.

    Values of writings with one reading are decided where they stand.  Only the others meet
    the fitted mixtures, in a join on (source, writing, set, decades).
    """
    read = with_readings(df, value, zone)
    possible = F.size(F.filter("_at", lambda x: x.isNotNull()))
    # Parsed once and written: filters on the parsed columns would else be pushed below the
    # parsing and repeat its whole expression at each use.
    read = materialise(read.withColumn("_open", F.coalesce(F.col("_writing").isin([*SEVERAL, *NUMBERS]) & (possible > 0), F.lit(False))))
    own = list(df.columns)
    at, mark = F.get("_at", F.lit(0)), F.get("_marks", F.lit(0))
    reading = F.concat_ws(":", "_writing", F.create_map(*[F.lit(x) for w in WRITINGS for x in (w, _readings_of(w)[0])])[F.col("_writing")])
    plain = read.filter(~F.col("_open")).select(*own, at.alias("utc_us"), F.when(at.isNotNull(), reading).alias("reading"), F.when(at.isNotNull(), F.lit(1.0)).alias("posterior"), F.when(at.isNotNull(), mark).alias("_mark"))
    open_ = read.filter("_open").withColumns({"_m": _mask(), "_y0": _decade(0), "_y1": _decade(1)})
    fitted = mixtures(read.filter(F.col("_writing").isNotNull()), source, conventions, beliefs, strength)
    fitted = fitted.select(F.col("source").alias("_source"), F.col("writing").alias("_w"), F.col("mask").alias("_mask"), "decade_0", "decade_1", F.col("reading").alias("_reading"), "position", F.col("posterior").alias("_posterior"), "weight")
    same = open_[source].eqNullSafe(F.col("_source")) & (F.col("_writing") == F.col("_w")) & (F.col("_m") == F.col("_mask")) & (F.col("_y0") == F.col("decade_0")) & (F.col("_y1") == F.col("decade_1"))
    sure = (F.col("_posterior") >= min_posterior) & (F.col("weight") >= min_weight)
    chosen = open_.join(fitted, same, "left").select(
        *own,
        F.when(sure, F.get(F.col("_at"), F.col("position"))).alias("utc_us"),
        F.when(F.col("_reading").isNotNull(), F.concat_ws(":", "_writing", "_reading")).alias("reading"),
        F.col("_posterior").alias("posterior"),
        F.get("_marks", F.col("position")).alias("_mark"),
    )
    status = F.when(F.col("utc_us").isNotNull(), F.when(F.col("_mark") == 1, "ambiguous_fold").when(F.col("_mark") == 2, "skipped").otherwise("resolved")).when(F.col("posterior").isNotNull(), "unresolved").otherwise("unreadable")
    return plain.unionByName(chosen).withColumn("status", status).drop("_mark")
