"""Calendar parts of instants, in UTC or in a named zone (daylight saving included)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local(ts: Column, tz: str) -> Column:
    """The wall time of a UTC instant in ``tz``."""
    return F.from_utc_timestamp(ts.cast("timestamp"), tz)


def with_local_time(df: DataFrame, ts: str, tz: str = "UTC") -> DataFrame:
    """Add local_ts, day, month (yyyy-MM), year, dow (Monday 0), hour and day_index (January 1st 0)."""
    t = F.col("local_ts")
    return df.withColumn("local_ts", local(F.col(ts), tz)).withColumns(
        {"day": F.date_format(t, "yyyy-MM-dd"), "month": F.date_format(t, "yyyy-MM"), "year": F.year(t), "dow": F.weekday(t), "hour": F.hour(t), "day_index": F.dayofyear(t) - 1}
    )


def shown(ts: Column, raw: Column) -> Column:
    """``Mon dd, yyyy  HH:MM``; the first 16 characters of ``raw`` where there is no instant."""
    return F.coalesce(F.date_format(ts, "MMM dd, yyyy  HH:mm"), F.substring(raw, 1, 16))
