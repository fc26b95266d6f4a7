"""Marts by change: stored parts of single months, merged when a mart is built.

A mart's sums add up over months, and so do its distinct songs if each month keeps
them as sets of the songs' dense numbers (32768 numbers to a bucket).  So every
calendar month has parts on the marts' grain before names are joined:

    parts_songs      song, artist: plays, minutes
    parts_artists    artist, bucket: plays, minutes, songs as words of 64 bits
    parts_patterns   weekday, hour, bucket: plays, minutes, bitmap of songs

The slots of a week are few, so their bitmaps are as many as the songs.  Artists are
many and each has few of a bucket's songs: only words with a song in them are kept, so
the parts never hold more words than the month has cells.  Rows are dealt to tasks by
month before a set is made, so no set is shuffled and a month's part is a few files.

A part remembers which fact attempts it was made from.  ``refresh_parts`` makes the
parts of the months whose attempts have changed since, from these months' cells
alone, and drops those of months that are gone; folding a month does not change
its cells, so its parts go on counting.  A mart merges the parts of all months,
joins the names as they are now, and is as exact as a build from the whole fact.
Minutes are rounded for each cell before they are summed, so parts keep decimals.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.measures import minutes_2dp, round_minutes
from cadence.operators.star import dim_table, fact_cells, number_songs
from cadence.plans.models import MART_NAMES, Models, mart_order, register_all, stg_songs
from cadence.session import small_groups
from cadence.sources.warehouse import ATTEMPT, NUMBERS, State, Warehouse

MONTH = ["year", "month"]
# A month's cells are dealt to tasks in parts of about this many.
DEALT_TOGETHER = 1_000_000


def _sums() -> list:
    return [F.sum("plays").alias("plays"), F.sum("minutes").alias("minutes")]


def changed_months(state: State) -> list[str]:
    """The months whose parts are missing or were made from other attempts."""
    return sorted(m for m, found in state.sources().items()
                  if state.parts.get(m, [None, None])[1] != State.signature(found))


def _with_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` with the bucket of each song number and the bit in it."""
    # Spark's buckets begin with number 1.
    number = F.col("number") + 1
    return rows.withColumns({"bucket": F.bitmap_bucket_number(number), "bit": F.bitmap_bit_position(number)})


def _largest_month(state: State, months: list[str]) -> int:
    """The stored cells of the largest of these months (layouts without row counts: 0)."""
    rows = dict.fromkeys(months, 0)
    for month in months:
        rows[month] += sum(state.rows.get(f"{month}/{a}", 0) for a in state.folded_runs(month))
        rows[month] += sum(f["months"].get(month, 0) for f in state.facts.values() if isinstance(f["months"], dict))
    return max(rows.values(), default=0)


def _dealt(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``rows`` dealt to tasks by month and, in ``parts`` parts a month, by ``keys``.

    ``part`` depends on the keys alone: grouping by it besides them changes nothing
    and needs no other shuffle.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    return rows.withColumn("part", part).repartition(*MONTH, "part")


def refresh_parts(warehouse: Warehouse) -> State:
    """Bring the parts up to date; return the state that they belong to."""
    while True:
        number_songs(warehouse)
        state = warehouse.state()
        months, gone = changed_months(state), set(state.parts) - set(state.sources())
        if not months and not gone:
            return state
        attempt = warehouse.new_attempt("parts")
        if months:
            _write_parts(warehouse, state, months, attempt)
        sources = state.sources()
        made = {m: [attempt, State.signature(sources[m])] for m in months}
        while True:
            now = warehouse.state()
            kept = {m: p for m, p in now.parts.items() if m in now.sources()}
            # Another refresh may have been faster: what it made of the present sources stays.
            done = warehouse.try_commit(now, parts=kept | {
                m: p for m, p in made.items()
                if m in now.sources() and kept.get(m, [None, None])[1] != State.signature(now.sources()[m])})
            if done:
                break
        if not changed_months(done):
            return done


def _write_parts(warehouse: Warehouse, state: State, months: list[str], attempt: str) -> None:
    cells = fact_cells(warehouse, state, months)
    streams = cells.where((F.col("play_count") > 0) & (F.col("total_duration") > 0)).select(
        *MONTH, "song_id", "artist_id", "date_id", F.col("play_count").alias("plays"),
        minutes_2dp(F.col("total_duration")).alias("minutes"))
    numbered = streams.join(warehouse.read_dim(NUMBERS, state), "song_id")
    parts = _largest_month(state, months) // DEALT_TOGETHER + 1

    def write(table: str, rows: DataFrame) -> None:
        small_groups(rows.drop("part").write).partitionBy(*MONTH).parquet(warehouse.attempt_path(table, attempt))

    def songs_and_artists() -> None:
        write("parts_songs", _dealt(numbered, ["song_id"], parts).groupBy(
            *MONTH, "part", "song_id", "number", "artist_id").agg(*_sums()))
        pairs = _with_buckets(warehouse.spark.read.parquet(warehouse.attempt_path("parts_songs", attempt)))
        grain = [*MONTH, "part", "artist_id", "bucket"]
        bits = F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))"))
        words = _dealt(pairs, ["artist_id", "bucket"], parts).groupBy(
            *grain, F.expr("cast(bit div 64 as int)").alias("word")).agg(*_sums(), bits.alias("bits"))
        write("parts_artists", words.groupBy(*grain).agg(
            *_sums(), F.collect_list(F.struct("word", "bits")).alias("songs")))

    def patterns() -> None:
        slots = dim_table(warehouse, "dim_date", state).select("date_id", "day_of_week", "hour_of_day")
        rows = _with_buckets(numbered.join(slots, "date_id")).select(
            *MONTH, "day_of_week", "hour_of_day", "bucket", "bit", "plays", "minutes")
        grain = ["day_of_week", "hour_of_day", "bucket"]
        write("parts_patterns", _dealt(rows, grain, parts).groupBy(*MONTH, "part", *grain).agg(
            *_sums(), F.bitmap_construct_agg("bit").alias("songs")))

    with ThreadPoolExecutor(max_workers=2) as pool:
        for job in [pool.submit(songs_and_artists), pool.submit(patterns)]:
            job.result()


def read_parts(warehouse: Warehouse, state: State, table: str) -> DataFrame | None:
    """The parts of all months, or None if there are none."""
    folders = [f"{warehouse.attempt_path(table, a)}/year={int(m[:4])}/month={int(m[5:])}"
               for m, (a, _) in sorted(state.parts.items())]
    if not folders:
        return None
    return warehouse.spark.read.option("basePath", warehouse.table_path(table)).parquet(*folders).drop(ATTEMPT)


def mart_from_parts(warehouse: Warehouse, state: State, name: str, ordered: bool = True) -> DataFrame:
    """A mart merged from the parts of ``state``; the same rows as ``Models.mart``."""
    table = {"mart_top_artists": "parts_artists", "mart_top_songs": "parts_songs",
             "mart_listening_patterns": "parts_patterns"}[name]
    parts = read_parts(warehouse, state, table)
    if parts is None:
        return Models.of(warehouse, state).mart(name, ordered)
    artists = dim_table(warehouse, "dim_artist", state).select("artist_id", "artist_name")
    if name == "mart_listening_patterns":
        slot = ["day_of_week", "hour_of_day"]
        merged = parts.groupBy(*slot, "bucket").agg(*_sums(), F.bitmap_or_agg("songs").alias("songs"))
        out = merged.groupBy(*slot).agg(
            F.sum("plays").alias("total_plays"), round_minutes(F.sum("minutes")).alias("total_minutes"),
            F.sum(F.bitmap_count("songs")).alias("unique_songs"))
    elif name == "mart_top_artists":
        # A part's sums go with the first of its words.
        words = parts.select("artist_id", "bucket", "plays", "minutes", F.posexplode("songs").alias("at", "song")).select(
            "artist_id", "bucket", "song.word", "song.bits",
            *[F.when(F.col("at") == 0, F.col(c)).alias(c) for c in ("plays", "minutes")])
        merged = words.join(artists, "artist_id").groupBy("artist_name", "bucket", "word").agg(
            *_sums(), F.bit_or("bits").alias("bits"))
        out = merged.groupBy("artist_name").agg(
            F.sum("plays").alias("total_plays"), round_minutes(F.sum("minutes")).alias("total_minutes_listened"),
            F.sum(F.bit_count("bits")).alias("unique_songs"))
    else:
        songs = stg_songs(dim_table(warehouse, "dim_song", state))
        # Dealt by song, so that the sums and the join with the songs take one shuffle.
        pairs = parts.repartition("song_id").groupBy("song_id", "artist_id").agg(*_sums())
        named = (pairs.join(songs.select("song_id", "song_title", "duration_minutes"), "song_id")
                 .join(artists, "artist_id"))
        out = named.groupBy("song_title", "artist_name", "duration_minutes").agg(
            F.sum("plays").alias("total_plays"), round_minutes(F.sum("minutes")).alias("total_minutes")).select(
            "song_title", "artist_name", "total_plays", "total_minutes",
            F.col("duration_minutes").alias("track_duration_minutes"))
    return out.orderBy(*mart_order(name)) if ordered else out


def build_marts_by_change(warehouse: Warehouse) -> Models:
    """Refresh the parts, merge every mart from them and publish all at once."""
    state = refresh_parts(warehouse)
    attempts = {name: warehouse.new_attempt("build") for name in MART_NAMES}

    def write(name: str) -> None:
        mart_from_parts(warehouse, state, name, ordered=False).write.parquet(
            warehouse.attempt_path(f"marts/{name}", attempts[name]))

    with ThreadPoolExecutor(max_workers=len(MART_NAMES)) as pool:
        list(pool.map(write, MART_NAMES))
    warehouse.publish_models(attempts)
    return register_all(warehouse)
