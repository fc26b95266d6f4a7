"""Play feeds derived from the driver's tables.

The driver tables hold no listening data, so plays are mapped from them
(same mapping as FIXTURES.md section 3).  Both feeds grow with the
tables they read.

``event_plays``     events x part x supplier: 60 songs, 10 artists,
                    many plays per cell (tests accumulation).
``lineitem_plays``  lineitem x part x supplier: songs and artists grow
                    with the scale factor (tests wide dimensions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The feed mapping (songs = user_id mod 60, artists = user_id
# mod 10; 60 is a multiple of 10 so every song has one artist).
EVENT_SONGS = 60
EVENT_ARTISTS = 10

PLAY_COLUMNS = ["play_id", "played_at", "song_title", "artist_name", "song_duration_ms",
                "artist_natural_key", "song_natural_key"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type")
    # The join keys are residues, so only parts 0..59 and suppliers 0..9 can
    # match.  Saying so lets the scans prune and bounds the small sides.
    part = (read_table(spark, sf_dir, "part")
            .where(F.col("p_partkey").between(0, EVENT_SONGS - 1)).select("p_partkey", "p_name"))
    supp = (read_table(spark, sf_dir, "supplier")
            .where(F.col("s_suppkey").between(0, EVENT_ARTISTS - 1)).select("s_suppkey", "s_name"))
    song_key = F.col("user_id") % EVENT_SONGS
    artist_key = F.col("user_id") % EVENT_ARTISTS
    plays = (ev.select("event_id", "ts", "value", "event_type",
                       song_key.alias("_song"), artist_key.alias("_artist"))
             .join(part, F.col("_song") == F.col("p_partkey"))
             .join(supp, F.col("_artist") == F.col("s_suppkey")))
    return plays.select(
        F.col("event_id").alias("play_id"),
        F.col("ts").cast("timestamp").alias("played_at"),
        F.col("p_name").alias("song_title"),
        F.col("s_name").alias("artist_name"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("song_duration_ms"),
        F.concat(F.lit("a"), F.col("_artist").cast("string")).alias("artist_natural_key"),
        F.concat(F.lit("s"), F.col("_song").cast("string")).alias("song_natural_key"),
        F.col("event_type"),
    )


def lineitem_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    plays = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
             .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))
    played_at = (F.col("l_shipdate").cast("timestamp")
                 + F.make_interval(hours=(F.col("l_orderkey") % 24).cast("int")))
    return plays.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("play_id"),
        played_at.alias("played_at"),
        F.col("p_name").alias("song_title"),
        F.col("s_name").alias("artist_name"),
        F.floor(F.col("l_extendedprice")).cast("bigint").alias("song_duration_ms"),
        F.concat(F.lit("a"), F.col("l_suppkey").cast("string")).alias("artist_natural_key"),
        F.concat(F.lit("s"), F.col("l_partkey").cast("string")).alias("song_natural_key"),
    )


def as_staged(plays: DataFrame, iso: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Render feed plays the way the extract step stages them (all text)."""
    from cadence.sources.raw_json import ISO_FORMAT

    played_at = (F.date_format("played_at", ISO_FORMAT) if iso
                 else F.col("played_at").cast("string"))
    return plays.select(
        "song_title", "artist_name", played_at.alias("played_at"),
        F.col("song_duration_ms").cast("string").alias("song_duration_ms"),
        "artist_natural_key", "song_natural_key", "play_id", *extra)
