"""Calendar parts of a play timestamp (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday_name(ts: Column) -> Column:
    """English full day name, capitalised ("Monday")."""
    return F.date_format(ts, "EEEE")


def calendar_parts(ts: Column) -> list[Column]:
    """year, month, hour_of_day (int) and day_of_week (capitalised)."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.hour(ts).alias("hour_of_day"),
        weekday_name(ts).alias("day_of_week"),
    ]


def to_play_timestamp(col: Column, dtype: str) -> Column:
    """Parse/convert a played_at column to TIMESTAMP.

    Strings are ISO-8601 and parsed strictly (ANSI mode raises on garbage);
    timestamps without zone are taken as UTC wall-clock time.
    """
    if dtype == "string":
        return F.to_timestamp(col)
    if dtype == "timestamp_ntz":
        return col.cast("timestamp")
    return col


def lenient_play_timestamp(col: Column, dtype: str) -> Column:
    """As ``to_play_timestamp``, but null where that fails."""
    return F.try_to_timestamp(col) if dtype == "string" else to_play_timestamp(col, dtype)


def window_cutoff(as_of: Column, days: int = 1) -> Column:
    """``as_of`` floored to whole seconds, minus ``days`` days."""
    return F.date_trunc("second", as_of) - F.make_interval(days=F.lit(days))
