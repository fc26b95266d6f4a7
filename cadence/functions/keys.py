"""Surrogate keys.

Dimension ids are a 64-bit hash of the natural key: every executor computes
the same id for the same key with no sequence, no coordination and no
single-partition ``row_number()``.  Collisions are detected by the
uniqueness checks on both the ids and the natural keys.  Fact cells are far
more numerous than dimension rows, so their id has 128 bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str) -> Column:
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def artist_id(nk: Column | str = "artist_natural_key") -> Column:
    return surrogate_key(nk)


def song_id(nk: Column | str = "song_natural_key") -> Column:
    return surrogate_key(nk)


def date_id(year="year", month="month", hour="hour_of_day", dow="day_of_week") -> Column:
    return surrogate_key(year, month, hour, dow)


def stream_id(date="date_id", song="song_id", artist="artist_id") -> Column:
    """The 128-bit id of a fact cell (16 bytes)."""
    return F.unhex(F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in (date, song, artist)])
                         .cast("binary")))
