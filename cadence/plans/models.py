"""Staging views and marts (the models of the original warehouse).

Staging views are plain DataFrame functions (inlined by Catalyst).  Marts
are aggregates written as tables.  Minutes are DECIMAL: per-cell minutes
are rounded to 2 places first, the marts sum those and round again to 1
place -- the two-step rounding is part of the result, not an artefact.

Marts of songs and artists pre-aggregate the fact before joining a dimension: the
fact's grain includes the calendar slot, these marts' does not, so collapsing it first
shrinks the join input by up to the number of slots per song.  Sums are
exact on decimals and distinct counts are unchanged, so results equal
the join-then-aggregate form.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.measures import minutes_2dp, round_minutes
from cadence.operators.star import dim_table, fact_song_stream
from cadence.sources.warehouse import State, Warehouse


# -- staging views (P8-P12, M1) -----------------------------------------------

def stg_streams(fact: DataFrame) -> DataFrame:
    return (fact.where((F.col("play_count") > 0) & (F.col("total_duration") > 0))
            .select("song_stream_id", "song_id", "artist_id", "date_id", "play_count",
                    "total_duration",
                    minutes_2dp(F.col("total_duration")).alias("total_duration_minutes")))


def stg_songs(dim_song: DataFrame) -> DataFrame:
    return dim_song.select("song_id", "song_natural_key", "song_title", "duration_ms",
                           minutes_2dp(F.col("duration_ms")).alias("duration_minutes"))


def stg_artists(dim_artist: DataFrame) -> DataFrame:
    return dim_artist.select("artist_id", "artist_natural_key", "artist_name")


def stg_dates(dim_date: DataFrame) -> DataFrame:
    return dim_date.select("date_id", "hour_of_day", "day_of_week", "month", "year")


# -- marts (A9-A11) -----------------------------------------------------------

def _per(streams: DataFrame, *grain: str) -> DataFrame:
    return streams.groupBy(*grain).agg(
        F.sum("play_count").alias("_plays"),
        F.sum("total_duration_minutes").alias("_minutes"))


def _distinct_songs(approx: bool):
    # Exact by default; approx_count_distinct (HyperLogLog++, ~1% error)
    # is an opt-in for very large song catalogues.
    return F.approx_count_distinct("song_id") if approx else F.count_distinct("song_id")


def mart_order(name: str) -> list:
    """The report order of a mart (O1, O2), made total by the names."""
    return {"mart_top_artists": [F.desc("total_plays"), F.asc("artist_name")],
            "mart_top_songs": [F.desc("total_plays"), F.asc("song_title"), F.asc("artist_name"),
                               F.asc("track_duration_minutes")],
            "mart_listening_patterns": [F.asc("day_of_week"), F.asc("hour_of_day")]}[name]


def _ordered(df: DataFrame, ordered: bool, name: str) -> DataFrame:
    # The report order is a global sort (a range shuffle); a stored table has
    # no order, so writers skip it and readers sort what they show.
    return df.orderBy(*mart_order(name)) if ordered else df


def mart_top_artists(streams: DataFrame, artists: DataFrame, approx_distinct: bool = False,
                     ordered: bool = True) -> DataFrame:
    per_pair = _per(streams, "artist_id", "song_id")
    joined = per_pair.join(artists.select("artist_id", "artist_name"), "artist_id")
    out = (joined.groupBy("artist_name")
           .agg(F.sum("_plays").alias("total_plays"),
                round_minutes(F.sum("_minutes")).alias("total_minutes_listened"),
                _distinct_songs(approx_distinct).alias("unique_songs")))
    return _ordered(out, ordered, "mart_top_artists")


def mart_top_songs(streams: DataFrame, songs: DataFrame, artists: DataFrame,
                   ordered: bool = True) -> DataFrame:
    per_pair = _per(streams, "song_id", "artist_id")
    joined = (per_pair
              .join(songs.select("song_id", "song_title", "duration_minutes"), "song_id")
              .join(artists.select("artist_id", "artist_name"), "artist_id"))
    out = (joined.groupBy("song_title", "artist_name", "duration_minutes")
           .agg(F.sum("_plays").alias("total_plays"),
                round_minutes(F.sum("_minutes")).alias("total_minutes"))
           .select("song_title", "artist_name", "total_plays", "total_minutes",
                   F.col("duration_minutes").alias("track_duration_minutes")))
    return _ordered(out, ordered, "mart_top_songs")


def mart_listening_patterns(streams: DataFrame, dates: DataFrame,
                            approx_distinct: bool = False, ordered: bool = True) -> DataFrame:
    # The calendar is small: with the slots at hand the distinct songs need one aggregation
    # of the fact, not one of (date, song) and another of (slot, song).
    joined = streams.join(dates.select("date_id", "day_of_week", "hour_of_day"), "date_id")
    out = (joined.groupBy("day_of_week", "hour_of_day")
           .agg(F.sum("play_count").alias("total_plays"),
                round_minutes(F.sum("total_duration_minutes")).alias("total_minutes"),
                _distinct_songs(approx_distinct).alias("unique_songs")))
    return _ordered(out, ordered, "mart_listening_patterns")


# -- model graph (W3) ----------------------------------------------------------

MART_NAMES = ("mart_top_artists", "mart_top_songs", "mart_listening_patterns")


@dataclass
class Models:
    stg_streams: DataFrame
    stg_songs: DataFrame
    stg_artists: DataFrame
    stg_dates: DataFrame

    def mart(self, name: str, ordered: bool = True) -> DataFrame:
        if name == "mart_top_artists":
            return mart_top_artists(self.stg_streams, self.stg_artists, ordered=ordered)
        if name == "mart_top_songs":
            return mart_top_songs(self.stg_streams, self.stg_songs, self.stg_artists,
                                  ordered=ordered)
        if name == "mart_listening_patterns":
            return mart_listening_patterns(self.stg_streams, self.stg_dates, ordered=ordered)
        raise KeyError(name)

    @staticmethod
    def of(warehouse: Warehouse, state: State) -> Models:
        return staging_models(warehouse, state=state)


def staging_models(warehouse: Warehouse, fact: DataFrame | None = None, state: State | None = None) -> Models:
    """The four staging views over the star tables (lazy), all of one state.

    ``fact`` may hold the fact of that state, if it is stored already.
    """
    state = state or warehouse.state()
    return Models(
        stg_streams=stg_streams(fact_song_stream(warehouse, state) if fact is None else fact),
        stg_songs=stg_songs(dim_table(warehouse, "dim_song", state)),
        stg_artists=stg_artists(dim_table(warehouse, "dim_artist", state)),
        stg_dates=stg_dates(dim_table(warehouse, "dim_date", state)),
    )


def register_views(models: Models) -> None:
    """Expose the staging views to SQL under their model names (K5)."""
    for name in ("stg_streams", "stg_songs", "stg_artists", "stg_dates"):
        getattr(models, name).createOrReplaceTempView(name)


@contextmanager
def stored_fact(warehouse: Warehouse):
    """(state, fact): the summed fact of the newest state, stored while in use.

    Models and checks read it several times; it is summed once.
    """
    state, path = warehouse.state(), warehouse.scratch_path("fact")
    try:
        fact_song_stream(warehouse, state).write.parquet(path)
        yield state, warehouse.spark.read.parquet(path)
    finally:
        warehouse.delete(path)


def register_all(warehouse: Warehouse) -> Models:
    """Expose staging views and published marts to SQL; return the views."""
    models = staging_models(warehouse)
    register_views(models)
    for name in MART_NAMES:
        if name in warehouse.state().models:
            warehouse.read_model(name).createOrReplaceTempView(name)
    return models


def build_models(warehouse: Warehouse) -> Models:
    """Run the model graph (W3): staging views, then every mart, published at once."""
    from cadence.plans.graph import run_models

    with stored_fact(warehouse) as (state, fact):
        run_models(warehouse, whole=True, all_or_nothing=True, fact=fact, state=state)
    return register_all(warehouse)
