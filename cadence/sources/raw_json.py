"""Raw play pages (landed API responses) -> flat staged plays.

S1  read landed pages (JSON Lines by default: splittable; ``multiline=True``
    for one pretty-printed document per file)
S2  flatten one item with the extract step's defaults
S3  time-window filter (plays after ``as_of`` - 1 day)
O3  newest-N cap (optionally per listener)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.functions.calendar import to_play_timestamp, window_cutoff
from cadence.functions.measures import strict_bigint
from cadence.functions.text import NA_TOKENS, na_to_null
from cadence.schemas import CORRUPT, LANDED_PAGE, RAW_PAGE, SOURCE, STAGED_COLUMNS

# Defaults the extract step uses when a field is absent.
MISSING_TEXT = "N/A"
MISSING_DURATION = 0

# ISO-8601 in UTC.  The feed keeps microseconds so no ordering is lost.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_raw_pages(spark: SparkSession, path: str | list[str], multiline: bool = False,
                   mode: str = "FAILFAST") -> DataFrame:
    """Landed pages with the fixed raw schema.  Malformed JSON fails the batch."""
    reader = spark.read.schema(RAW_PAGE).option("mode", mode).option("multiLine", multiline)
    return reader.json(path)


def explode_items(pages: DataFrame) -> DataFrame:
    """One row per play item (pages without items contribute nothing)."""
    return pages.select(F.explode("items").alias("item"))


def flatten_items(items: DataFrame, keep: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """The six staged columns, with the extract step's defaults.

    First artist only; an empty or missing artist list gives name "N/A"
    and a null id.  ``F.get`` is used because ``arr[0]`` raises on an
    empty array under ANSI.  A duration that is no integer fails the batch;
    without ``strict`` durations stay text, for ``examine_plays`` to judge.
    """
    duration = F.variant_get(F.col("item.track.duration_ms"), "$", "string")
    if strict:
        duration, zero = strict_bigint(duration), F.lit(MISSING_DURATION).cast("bigint")
    else:
        zero = F.lit(str(MISSING_DURATION))
    track = F.col("item.track")
    first_artist = F.get(track["artists"], F.lit(0))
    return items.select(
        F.coalesce(track["name"], F.lit(MISSING_TEXT)).alias("song_title"),
        F.coalesce(first_artist["name"], F.lit(MISSING_TEXT)).alias("artist_name"),
        F.coalesce(F.col("item.played_at"), F.lit(MISSING_TEXT)).alias("played_at"),
        # Absent counts as 0 ms; an explicit null stays null (its row is dropped).
        F.when(track["duration_ms"].isNull(), zero)
        .when(~F.is_variant_null(track["duration_ms"]), duration).alias("song_duration_ms"),
        first_artist["id"].alias("artist_natural_key"),
        track["id"].alias("song_natural_key"),
        *keep,
    ).select(*STAGED_COLUMNS, *keep)


def landed_items(pages: DataFrame) -> DataFrame:
    """The items of ``LANDED_PAGE`` rows, and one row for each text that is no page.

    ``_corrupt`` holds that text, else it is null; ``_source`` names the file.
    """
    return (pages.select(F.explode_outer("items").alias("item"), CORRUPT, F.col("_metadata.file_path").alias(SOURCE))
            .where(F.col("item").isNotNull() | F.col(CORRUPT).isNotNull()))


def read_landed_items(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Staged plays as text, with ``_corrupt`` and ``_source``, from pages of which some may be malformed."""
    pages = spark.read.schema(LANDED_PAGE).option("mode", "PERMISSIVE").option("multiLine", multiline) \
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return flatten_items(landed_items(pages), (CORRUPT, SOURCE), strict=False)


def read_staged_from_json(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    return flatten_items(explode_items(read_raw_pages(spark, path, multiline=multiline)))


def _as_column(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (dt.datetime, str)):
        return F.lit(as_of).cast("timestamp")
    raise TypeError(f"as_of must be a Column, datetime or ISO string, not {type(as_of)!r}")


def played_at_ts(df: DataFrame) -> Column:
    """The time of a play.  A missing one (null or a missing-value token) is null;
    one that can't be parsed fails the batch, as in the transform step."""
    dtype = dict(df.dtypes)["played_at"]
    if dtype == "string":
        return to_play_timestamp(na_to_null(F.col("played_at"), list(NA_TOKENS)), dtype)
    return F.col("played_at").cast("timestamp")


def recent_window(plays: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Plays strictly after ``as_of`` (floored to the second) minus ``days``, up to ``as_of``.

    The upper end makes a retry, when later plays have landed, take the same plays.
    """
    ts, end = played_at_ts(plays), _as_column(as_of)
    return plays.where((ts > window_cutoff(end, days)) & (ts <= end))


def latest_plays(plays: DataFrame, n: int = 50, per: str | None = None,
                 tie_break: str = "play_id") -> DataFrame:
    """Newest ``n`` plays overall, or per value of ``per``.

    Overall: a TakeOrderedAndProject (per-task top-n, then merge).  Per key:
    ``row_number() <= n``, which Spark plans with a partial group limit
    before the shuffle, so a hot key ships at most n rows per task.
    """
    order = [played_at_ts(plays).desc()]
    if tie_break in plays.columns:
        order.append(F.col(tie_break).desc())
    if per is None:
        return plays.orderBy(*order).limit(n)
    w = Window.partitionBy(per).orderBy(*order)
    return plays.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def to_raw_pages(plays: DataFrame, page_size: int = 50, by: str | None = None,
                 played_at: Column | None = None, duration: Column | None = None) -> DataFrame:
    """Render plays as landed pages: one JSON document per line, <= page_size items.

    Expects played_at (timestamp), song_title, artist_name, song_duration_ms,
    artist_natural_key, song_natural_key.  With a ``play_id`` column a page
    is a run of ``page_size`` consecutive ids: deterministic under task
    retries, and bounded by ``page_size`` times the id's multiplicity.
    Without one, pages are cut from consecutive rows of one input partition.
    ``by`` names a column that is constant within a page and kept beside it.
    ``played_at`` and ``duration`` give texts to land instead of a play's own (null: its own).
    """
    own_time = F.date_format(F.col("played_at"), ISO_FORMAT)
    own_duration = F.col("song_duration_ms").cast("bigint")
    if duration is not None:
        own_duration = F.coalesce(duration, own_duration.cast("string"))
    item = F.struct(
        (own_time if played_at is None else F.coalesce(played_at, own_time)).alias("played_at"),
        F.struct(
            F.col("song_title").alias("name"),
            F.col("song_natural_key").alias("id"),
            own_duration.alias("duration_ms"),
            F.array(F.struct(F.col("artist_natural_key").alias("id"),
                             F.col("artist_name").alias("name"))).alias("artists"),
        ).alias("track"),
    )
    key = "CAST(play_id AS BIGINT)" if "play_id" in plays.columns else "monotonically_increasing_id()"
    keep = [by] if by else []
    paged = plays.select(F.expr(f"{key} div {int(page_size)}").alias("_page"), item.alias("item"), *keep)
    return (paged.groupBy("_page", *keep).agg(F.collect_list("item").alias("items"))
            .select(F.to_json(F.struct("items")).alias("value"), *keep))


def write_raw_pages(pages: DataFrame, path: str) -> None:
    pages.write.mode("overwrite").text(path)
