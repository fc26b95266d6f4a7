"""Cleaning (the transform step), as one narrow DataFrame plan.

Order of the rules, as in the original step:
  P3  abort on an empty batch (checked before null filtering)
  P7  missing-value tokens ("N/A", "NA", "null", ...) -> null, exact match
  P4-P6  drop rows missing title, artist name, played_at or duration
  F4-F8  played_at -> UTC calendar parts
  F1/F2  artist name and title: lower-case, then Unicode strip
  F12 duration: strict integer parse (a bad value fails the batch)
  P2  played_at leaves the processed layer (``to_processed``)

``clean_plays`` keeps ``played_at`` and ``play_id`` as trailing lineage
columns: the star loader needs them to pick the newest attributes per
key deterministically (Spark has no row order to fall back on).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.calendar import calendar_parts, lenient_play_timestamp, to_play_timestamp
from cadence.functions.keys import surrogate_key
from cadence.functions.measures import lenient_bigint, strict_bigint
from cadence.functions.text import NA_TOKENS, na_to_null, normalise_name
from cadence.schemas import CORRUPT, PROCESSED_COLUMNS, REJECT, SOURCE, STAGED_COLUMNS

REQUIRED = ["song_title", "artist_name", "played_at", "song_duration_ms"]
LINEAGE_COLUMNS = ["played_at", "play_id"]


class EmptyBatchError(RuntimeError):
    """The staged batch holds no rows at all."""


class RejectedPlaysError(RuntimeError):
    """Plays without a natural key reached the loader."""


def check_not_empty(df: DataFrame) -> DataFrame:
    """Fail on a batch with zero rows (a one-row probe job, not a count)."""
    if df.isEmpty():
        raise EmptyBatchError("no plays in this batch; stopping")
    return df


def with_play_id(staged: DataFrame) -> DataFrame:
    """Give every staged row a deterministic ``play_id`` if it has none.

    Hash of the six staged values, with a mark for nulls (the hash skips
    them): two rows that tie on it are identical, so which one "wins" never
    matters.
    """
    if "play_id" in staged.columns:
        return staged
    return staged.withColumn("play_id", surrogate_key(
        *[x for c in STAGED_COLUMNS for x in (F.col(c).isNull(), F.col(c).cast("string"))]))


def clean_plays(staged: DataFrame, na_tokens: Iterable[str] = NA_TOKENS,
                check_empty: bool = False) -> DataFrame:
    """Staged plays -> processed plays (+ ``played_at``, ``play_id``)."""
    if check_empty:
        check_not_empty(staged)
    staged = with_play_id(staged)
    dtypes = dict(staged.dtypes)
    tokens = list(na_tokens)

    def text(c: str):
        return na_to_null(F.col(c), tokens) if dtypes[c] == "string" else F.col(c)

    nulled = staged.select(*[text(c).alias(c) for c in STAGED_COLUMNS], F.col("play_id"))
    kept = nulled.where(reduce(and_, [F.col(c).isNotNull() for c in REQUIRED]))

    ts = to_play_timestamp(F.col("played_at"), dtypes["played_at"])
    return kept.select(
        normalise_name("song_title").alias("song_title"),
        normalise_name("artist_name").alias("artist_name"),
        strict_bigint(F.col("song_duration_ms")).alias("song_duration_ms"),
        "artist_natural_key",
        "song_natural_key",
        *calendar_parts(ts),
        ts.alias("played_at"),
        "play_id",
    )


def examine_plays(staged: DataFrame, na_tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """The rules of ``clean_plays`` without failing: ``REJECT`` rows, good plays with no reason.

    Where the cleaning would fail the batch, the row says why (``reason``) and
    what it was (``record``): a text that is no page (``_corrupt``), a time or a
    duration that can't be read.  Plays without a required value are dropped here as
    there.  ``source`` is the file, where the staged rows know it.
    """
    staged = with_play_id(staged)
    dtypes, tokens = dict(staged.dtypes), list(na_tokens)

    def text(c: str):
        return na_to_null(F.col(c), tokens) if dtypes[c] == "string" else F.col(c)

    corrupt = F.col(CORRUPT) if CORRUPT in dtypes else F.lit(None).cast("string")
    nulled = staged.select(
        *[text(c).alias(c) for c in STAGED_COLUMNS], "play_id", corrupt.alias(CORRUPT),
        (F.col(SOURCE) if SOURCE in dtypes else F.lit(None).cast("string")).alias("source"),
        F.coalesce(corrupt, F.to_json(F.struct(*STAGED_COLUMNS))).alias("record"))
    kept = nulled.where(F.col(CORRUPT).isNotNull() | reduce(and_, [F.col(c).isNotNull() for c in REQUIRED]))
    kept = kept.withColumns({
        "_ts": lenient_play_timestamp(F.col("played_at"), dtypes["played_at"]),
        "_ms": lenient_bigint(F.col("song_duration_ms"), dtypes["song_duration_ms"])})
    reason = (F.when(F.col(CORRUPT).isNotNull(), "malformed page")
              .when(F.col("_ts").isNull(), "unreadable played_at")
              .when(F.col("_ms").isNull(), "unreadable song_duration_ms"))
    whole = F.col(CORRUPT).isNull()
    return kept.withColumn("reason", reason).select(
        *[F.when(whole, normalise_name(c)).alias(c) for c in ("song_title", "artist_name")],
        F.when(whole, F.col("_ms")).alias("song_duration_ms"), "artist_natural_key", "song_natural_key",
        *calendar_parts(F.col("_ts")), F.col("_ts").alias("played_at"), F.when(whole, F.col("play_id")).alias("play_id"),
        "reason", F.when(F.col("reason").isNotNull(), F.col("record")).alias("record"),
        F.when(F.col("reason").isNotNull(), F.col("source")).alias("source")).select(*REJECT.names)


def good_plays(examined: DataFrame) -> DataFrame:
    """The plays of ``examine_plays`` that nothing is wrong with, as ``clean_plays`` returns them."""
    return examined.where(F.col("reason").isNull()).drop("reason", "record", "source")


def refused_rows(examined: DataFrame) -> DataFrame:
    return examined.where(F.col("reason").isNotNull())


def to_processed(plays: DataFrame) -> DataFrame:
    """The nine processed columns only (drops the lineage columns)."""
    return plays.select(*PROCESSED_COLUMNS)
