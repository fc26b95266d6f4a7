"""Durations and minutes.  Minutes stay DECIMAL end to end."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_MS_PER_MINUTE = Decimal("60000.0")


def strict_bigint(col: Column) -> Column:
    """Strict integer parse: '12', ' 12 ' pass; 'abc', '123.5' fail the job.

    Relies on ANSI mode (set by ``cadence.session``).  Doubles are
    truncated towards zero, like Python's ``int()``.
    """
    return col.cast("bigint")


def lenient_bigint(col: Column, dtype: str) -> Column:
    """As ``strict_bigint``, but null where that fails."""
    if dtype == "string":
        return col.try_cast("bigint")
    return col.cast("double").try_cast("bigint") if dtype in ("float", "double") else col.try_cast("bigint")


def minutes_2dp(ms: Column) -> Column:
    """``round(ms / 60000.0, 2)`` as an exact decimal, half rounded up."""
    return F.round(ms / F.lit(_MS_PER_MINUTE), 2)


def round_minutes(total: Column, digits: int = 1) -> Column:
    """Round an (already summed) decimal minute total."""
    return F.round(total, digits)
