"""Explicit schemas at every boundary -- nothing is inferred."""

from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()
_I = T.IntegerType()

ARTIST_REF = T.StructType([T.StructField("id", _S), T.StructField("name", _S)])

TRACK = T.StructType([
    T.StructField("name", _S),
    T.StructField("id", _S),
    # As landed: a missing duration and an explicit null must stay apart.
    T.StructField("duration_ms", T.VariantType()),
    T.StructField("artists", T.ArrayType(ARTIST_REF)),
])

PLAY_ITEM = T.StructType([
    T.StructField("played_at", _S),
    T.StructField("track", TRACK),
])

# One landed page of the "recently played" feed: {"items": [...]}.
RAW_PAGE = T.StructType([T.StructField("items", T.ArrayType(PLAY_ITEM))])

# Staged play: the six flat columns of the extract step, in order.
STAGED_COLUMNS = ["song_title", "artist_name", "played_at", "song_duration_ms",
                  "artist_natural_key", "song_natural_key"]
STAGED = T.StructType([T.StructField(c, _S) for c in STAGED_COLUMNS])

# A landed page read without failing: the text of what is no page, and where it stood.
CORRUPT = "_corrupt"
SOURCE = "_source"
LANDED_PAGE = T.StructType([*RAW_PAGE.fields, T.StructField(CORRUPT, _S)])

# Processed play: played_at replaced by four calendar parts.
PROCESSED_COLUMNS = ["song_title", "artist_name", "song_duration_ms", "artist_natural_key",
                     "song_natural_key", "year", "month", "hour_of_day", "day_of_week"]
PROCESSED = T.StructType([
    T.StructField("song_title", _S),
    T.StructField("artist_name", _S),
    T.StructField("song_duration_ms", _L),
    T.StructField("artist_natural_key", _S),
    T.StructField("song_natural_key", _S),
    T.StructField("year", _I),
    T.StructField("month", _I),
    T.StructField("hour_of_day", _I),
    T.StructField("day_of_week", _S),
])

# A refused play or page: the play as far as it was cleaned, why it was refused, and for
# what could not be cleaned the record as it came, with the file it came from.
REJECT = T.StructType([
    *PROCESSED.fields,
    T.StructField("played_at", T.TimestampType()),
    T.StructField("play_id", _L),
    T.StructField("reason", _S),
    T.StructField("record", _S),
    T.StructField("source", _S),
])

# Star schema.  Dimension ids are 64-bit hashes of the natural key, the fact's
# id has 128 bits and is derived when read (see keys.py);
# counts and durations are 64-bit so a busy cell cannot overflow.
DIM_ARTIST = T.StructType([
    T.StructField("artist_id", _L),
    T.StructField("artist_name", _S),
    T.StructField("artist_natural_key", _S),
])
DIM_SONG = T.StructType([
    T.StructField("song_id", _L),
    T.StructField("song_title", _S),
    T.StructField("duration_ms", _L),
    T.StructField("song_natural_key", _S),
])
DIM_DATE = T.StructType([
    T.StructField("date_id", _L),
    T.StructField("year", _I),
    T.StructField("month", _I),
    T.StructField("hour_of_day", _I),
    T.StructField("day_of_week", _S),
])
FACT_SONG_STREAM = T.StructType([
    T.StructField("song_stream_id", T.BinaryType()),
    T.StructField("date_id", _L),
    T.StructField("song_id", _L),
    T.StructField("artist_id", _L),
    T.StructField("play_count", _L),
    T.StructField("total_duration", _L),
])

# A dense number for each song, from 0 on, for bitmaps of songs.
SONG_NUMBERS = T.StructType([T.StructField("song_id", _L), T.StructField("number", _L)])

# What tells a play from all others: a listener starts a song once at a time.
PLAY_KEYS = T.StructType([T.StructField("listener", _S), T.StructField("played_at", T.TimestampType()),
                          T.StructField("song_natural_key", _S)])

STAR_TABLES = {
    "dim_artist": DIM_ARTIST,
    "dim_song": DIM_SONG,
    "dim_date": DIM_DATE,
    "fact_song_stream": FACT_SONG_STREAM,
}
