"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code: the star schema is derived with
window functions and GROUP BY straight from the feed, minutes with exact
integer arithmetic -- hundredths = (ms*100 + 30000) // 60000, i.e. half
rounded up -- so decimal-vs-double differences cannot hide.  Natural keys
stand in for the hashed ids.
"""

from __future__ import annotations

EVENT_FEED = """
feed AS (
  SELECT e.event_id AS play_id, e.ts AS played_at, p.p_name AS song_title,
         s.s_name AS artist_name, CAST(floor(e.value * 1000) AS BIGINT) AS song_duration_ms,
         'a' || CAST(e.user_id % 10 AS VARCHAR) AS artist_natural_key,
         's' || CAST(e.user_id % 60 AS VARCHAR) AS song_natural_key,
         e.event_type
  FROM events e
  JOIN part p ON p.p_partkey = e.user_id % 60
  JOIN supplier s ON s.s_suppkey = e.user_id % 10)"""

LINEITEM_FEED = """
feed AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS play_id,
         l.l_shipdate + to_hours(CAST(l.l_orderkey % 24 AS INTEGER)) AS played_at,
         p.p_name AS song_title, s.s_name AS artist_name,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS song_duration_ms,
         'a' || CAST(l.l_suppkey AS VARCHAR) AS artist_natural_key,
         's' || CAST(l.l_partkey AS VARCHAR) AS song_natural_key,
         '' AS event_type
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey)"""


def _plays(title="song_title", source="feed", batch="1"):
    return f"""
plays AS (
  SELECT play_id, played_at, lower(trim({title})) AS song_title,
         lower(trim(artist_name)) AS artist_name, song_duration_ms,
         artist_natural_key, song_natural_key,
         CAST(year(played_at) AS INTEGER) AS year, CAST(month(played_at) AS INTEGER) AS month,
         CAST(hour(played_at) AS INTEGER) AS hour_of_day, dayname(played_at) AS day_of_week,
         {batch} AS batch
  FROM {source})"""


STAR = """
cells AS (
  SELECT song_natural_key, artist_natural_key, year, month, hour_of_day,
         lower(day_of_week) AS day_of_week,
         CAST(COUNT(*) AS BIGINT) AS play_count,
         CAST(SUM(song_duration_ms) AS BIGINT) AS total_duration
  FROM plays GROUP BY ALL),
dim_song AS (
  SELECT song_natural_key, song_title, duration_ms FROM (
    SELECT song_natural_key, song_title, song_duration_ms AS duration_ms,
           row_number() OVER (PARTITION BY song_natural_key
                              ORDER BY batch, played_at DESC, play_id DESC,
                                       song_title DESC, song_duration_ms DESC) AS rn
    FROM plays) WHERE rn = 1),
dim_artist AS (
  SELECT artist_natural_key, artist_name FROM (
    SELECT artist_natural_key, artist_name,
           row_number() OVER (PARTITION BY artist_natural_key
                              ORDER BY batch, played_at DESC, play_id DESC,
                                       artist_name DESC) AS rn
    FROM plays) WHERE rn = 1),
dim_date AS (
  SELECT DISTINCT year, month, hour_of_day, lower(day_of_week) AS day_of_week FROM plays),
streams AS (
  SELECT *, (total_duration * 100 + 30000) // 60000 AS hundredths
  FROM cells WHERE play_count > 0 AND total_duration > 0)"""


def _with(feed: str, *parts: str) -> str:
    return "WITH " + ",".join((feed,) + parts)


def _star(feed=EVENT_FEED, plays=None) -> str:
    return _with(feed, plays or _plays(), STAR)


MART_TOP_ARTISTS = """
SELECT a.artist_name, CAST(SUM(c.play_count) AS BIGINT) AS total_plays,
       ((CAST(SUM(c.hundredths) AS BIGINT) + 5) // 10) / 10.0 AS total_minutes_listened,
       COUNT(DISTINCT c.song_natural_key) AS unique_songs
FROM streams c JOIN dim_artist a USING (artist_natural_key)
GROUP BY a.artist_name"""

MART_TOP_SONGS = """
SELECT so.song_title, a.artist_name, CAST(SUM(c.play_count) AS BIGINT) AS total_plays,
       ((CAST(SUM(c.hundredths) AS BIGINT) + 5) // 10) / 10.0 AS total_minutes,
       so.track_hundredths / 100.0 AS track_duration_minutes
FROM streams c
JOIN (SELECT *, (duration_ms * 100 + 30000) // 60000 AS track_hundredths FROM dim_song) so
  USING (song_natural_key)
JOIN dim_artist a USING (artist_natural_key)
GROUP BY so.song_title, a.artist_name, so.track_hundredths"""

MART_LISTENING_PATTERNS = """
SELECT c.day_of_week, c.hour_of_day, CAST(SUM(c.play_count) AS BIGINT) AS total_plays,
       ((CAST(SUM(c.hundredths) AS BIGINT) + 5) // 10) / 10.0 AS total_minutes,
       COUNT(DISTINCT c.song_natural_key) AS unique_songs
FROM streams c
GROUP BY c.day_of_week, c.hour_of_day"""

# The three marts in one table.
ALL_MARTS = f"""
SELECT 'mart_top_artists' AS mart, artist_name AS name, '' AS detail, total_plays,
       CAST(total_minutes_listened AS DOUBLE) AS total_minutes, CAST(unique_songs AS DOUBLE) AS number
FROM ({MART_TOP_ARTISTS})
UNION ALL
SELECT 'mart_top_songs', song_title, artist_name, total_plays, CAST(total_minutes AS DOUBLE),
       CAST(track_duration_minutes AS DOUBLE)
FROM ({MART_TOP_SONGS})
UNION ALL
SELECT 'mart_listening_patterns', day_of_week, CAST(hour_of_day AS VARCHAR), total_plays,
       CAST(total_minutes AS DOUBLE), CAST(unique_songs AS DOUBLE)
FROM ({MART_LISTENING_PATTERNS})"""

CELLS_OUT = """
SELECT song_natural_key, artist_natural_key, year, month, hour_of_day, day_of_week,
       play_count, total_duration FROM cells"""

PROCESSED_OUT = """
SELECT song_title, artist_name, song_duration_ms, artist_natural_key, song_natural_key,
       year, month, hour_of_day, day_of_week FROM plays"""

# (check_id, model, column_name, test, oracle relation, key expression)
_CHECKS = [
    ("D1", "stg_streams", "song_stream_id", "unique", "streams", "cell"),
    ("D2", "stg_streams", "song_stream_id", "not_null", "streams", "cell"),
    ("D3", "stg_streams", "play_count", "not_null", "streams", "play_count"),
    ("D4", "stg_streams", "total_duration", "not_null", "streams", "total_duration"),
    ("D5", "stg_artists", "artist_id", "unique", "dim_artist", "artist_natural_key"),
    ("D6", "stg_artists", "artist_id", "not_null", "dim_artist", "artist_natural_key"),
    ("D7", "stg_artists", "artist_name", "not_null", "dim_artist", "artist_name"),
    ("D8", "stg_songs", "song_id", "unique", "dim_song", "song_natural_key"),
    ("D9", "stg_songs", "song_id", "not_null", "dim_song", "song_natural_key"),
    ("D10", "stg_songs", "song_title", "not_null", "dim_song", "song_title"),
    ("D11a", "dim_artist", "artist_natural_key", "unique", "dim_artist", "artist_natural_key"),
    ("D11b", "dim_song", "song_natural_key", "unique", "dim_song", "song_natural_key"),
    ("D11c", "dim_date", "year,month,hour_of_day,day_of_week", "unique", "dim_date", "date"),
    ("D12a", "fact_song_stream", "date_id", "relationships", "cells", "date"),
    ("D12b", "fact_song_stream", "song_id", "relationships", "cells", "song_natural_key"),
    ("D12c", "fact_song_stream", "artist_id", "relationships", "cells", "artist_natural_key"),
]
_KEY = {
    "cell": "song_natural_key, artist_natural_key, year, month, hour_of_day, day_of_week",
    "date": "year, month, hour_of_day, day_of_week",
}
_PARENT = {"date": "dim_date", "song_natural_key": "dim_song", "artist_natural_key": "dim_artist"}


def _failures(test: str, rel: str, key: str) -> str:
    cols = _KEY.get(key, key)
    first = cols.split(",")[0].strip()
    if test == "unique":
        return (f"(SELECT COUNT(*) FROM (SELECT {cols} FROM {rel} WHERE {first} IS NOT NULL "
                f"GROUP BY {cols} HAVING COUNT(*) > 1))")
    if test == "not_null":
        return f"(SELECT COUNT(*) FROM {rel} WHERE {first} IS NULL)"
    parent = _PARENT[key]
    return (f"(SELECT COUNT(*) FROM {rel} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p "
            f"WHERE ({', '.join('p.' + c.strip() for c in cols.split(','))}) = "
            f"({', '.join('c.' + c.strip() for c in cols.split(','))})))")


def _broken_failures(test: str, rel: str) -> str:
    # Broken copies: every unique key duplicated, every tested column nulled
    # once, every fact row orphaned once -> each check fails once per row.
    return f"(SELECT COUNT(*) FROM {rel})"


def _suite(broken: bool, feed: str = EVENT_FEED) -> str:
    rows = []
    for cid, model, col, test, rel, key in _CHECKS:
        n = _broken_failures(test, rel) if broken else _failures(test, rel, key)
        rows.append(f"SELECT '{cid}' AS check_id, '{model}' AS model, '{col}' AS column_name, "
                    f"'{test}' AS test, CAST({n} AS BIGINT) AS failures")
    return _star(feed) + "\n" + "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    star = _star()
    wide = _star(LINEITEM_FEED)
    dirty = _with(EVENT_FEED, """
dirty AS (
  SELECT * FROM feed WHERE event_type NOT IN ('error', 'click'))""", _plays(source="dirty"))
    csv = _with(EVENT_FEED, _plays(title="song_title || ' say \"hi\", ok'"))
    first_wins = _with(EVENT_FEED, _plays(
        title="song_title || ' ' || event_type",
        batch="CASE WHEN played_at < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END"), STAR)
    first_wins_wide = _with(LINEITEM_FEED, _plays(
        title="song_title || ' ' || CAST(play_id AS VARCHAR)",
        batch="CASE WHEN played_at < TIMESTAMP '1998-05-24 00:00:00' THEN 1 ELSE 2 END"), STAR)
    # b1 again with even songs only: dimension rows stay, its other cells go.
    smaller = _with(EVENT_FEED, _plays(
        batch="CASE WHEN played_at < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END"),
        STAR.replace("FROM plays GROUP BY ALL", "FROM plays WHERE batch = 2 OR "
                     "CAST(substr(song_natural_key, 2) AS BIGINT) % 2 = 0 GROUP BY ALL"))
    smaller_wide = _with(LINEITEM_FEED, _plays(
        batch="CASE WHEN played_at < TIMESTAMP '1998-05-24 00:00:00' THEN 1 ELSE 2 END"),
        STAR.replace("FROM plays GROUP BY ALL", "FROM plays WHERE batch = 2 OR "
                     "CAST(substr(song_natural_key, 2) AS BIGINT) % 2 = 0 GROUP BY ALL"))
    # Every seventh page is cut off; of the other plays views, errors and purchases are refused.
    quarantine = _with(EVENT_FEED, """
landed AS (
  SELECT *, play_id // 50 AS page, played_at >= TIMESTAMP '2024-01-16 00:00:00' AS late,
         (play_id // 50) % 7 = 3 AS cut FROM feed),
bad AS (
  SELECT 'malformed page' AS name, COUNT(DISTINCT (page, late)) AS plays FROM landed WHERE cut
  UNION ALL SELECT 'no song id', COUNT(*) FROM landed WHERE NOT cut AND event_type = 'view'
  UNION ALL SELECT 'unreadable played_at', COUNT(*) FROM landed WHERE NOT cut AND event_type = 'error'
  UNION ALL SELECT 'unreadable song_duration_ms', COUNT(*) FROM landed WHERE NOT cut AND event_type = 'purchase')""")
    return {
        "incremental_quarantine": quarantine + """
SELECT 'loaded' AS kind, song_natural_key AS name, artist_natural_key AS detail,
       CAST(COUNT(*) AS BIGINT) AS plays, CAST(SUM(song_duration_ms) AS BIGINT) AS total_duration
FROM landed WHERE NOT cut AND event_type NOT IN ('view', 'error', 'purchase')
GROUP BY song_natural_key, artist_natural_key
UNION ALL SELECT 'refused', name, '', plays, NULL FROM bad WHERE plays > 0""",
        "incremental_overlap": star + CELLS_OUT,
        "fact_tiered": star + CELLS_OUT,
        "marts_incremental": smaller + ALL_MARTS,
        "marts_incremental_wide": smaller_wide + ALL_MARTS,
        "mart_top_artists": star + MART_TOP_ARTISTS,
        "mart_top_songs": star + MART_TOP_SONGS,
        "mart_listening_patterns": star + MART_LISTENING_PATTERNS,
        "clean_plays": dirty + PROCESSED_OUT,
        "raw_json_flatten": _with(EVENT_FEED) + """
SELECT song_title, artist_name, strftime(played_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS played_at,
       song_duration_ms, artist_natural_key, song_natural_key FROM feed""",
        "recent_plays_top50": _with(EVENT_FEED) + """
SELECT play_id, song_title, artist_name, song_duration_ms, epoch_us(played_at) AS played_at_us
FROM feed
WHERE played_at > date_trunc('second', (SELECT max(played_at) FROM feed)) - INTERVAL 1 DAY
ORDER BY played_at DESC, play_id DESC
LIMIT 50""",
        "staging_csv_roundtrip": csv + PROCESSED_OUT,
        "dim_artist": star + "\nSELECT artist_natural_key, artist_name FROM dim_artist",
        "dim_song": star + "\nSELECT song_natural_key, song_title, duration_ms FROM dim_song",
        "dim_date": star + "\nSELECT year, month, hour_of_day, day_of_week FROM dim_date",
        "dim_first_wins": first_wins
        + "\nSELECT song_natural_key, song_title, duration_ms FROM dim_song",
        "key_resolution": star + CELLS_OUT,
        "fact_song_stream": star + CELLS_OUT,
        "fact_two_batches": star + CELLS_OUT,
        "fact_batch_replay": star + CELLS_OUT,
        "fact_compacted": star + CELLS_OUT,
        "rejected_plays": _with(EVENT_FEED, _plays(source="(SELECT * FROM feed WHERE event_type = 'view')")) + """
SELECT play_id, song_title, artist_name, song_duration_ms FROM plays""",
        "stg_streams": star + """
SELECT song_natural_key, artist_natural_key, year, month, hour_of_day, day_of_week,
       play_count, total_duration, hundredths / 100.0 AS total_duration_minutes FROM streams""",
        "stg_songs": star + """
SELECT song_natural_key, song_title, duration_ms,
       ((duration_ms * 100 + 30000) // 60000) / 100.0 AS duration_minutes FROM dim_song""",
        "stg_artists": star + "\nSELECT artist_natural_key, artist_name FROM dim_artist",
        "stg_dates": star + "\nSELECT hour_of_day, day_of_week, month, year FROM dim_date",
        "dq_suite": _suite(broken=False),
        "dq_suite_broken": _suite(broken=True),
        "incremental_marts": star + ALL_MARTS,
        "batch_job_marts": star + ALL_MARTS,
        "incremental_two_streams": star + CELLS_OUT,
        "fact_replay_smaller": smaller + MART_TOP_SONGS,
        "mart_top_artists_wide": wide + MART_TOP_ARTISTS,
        "mart_top_songs_wide": wide + MART_TOP_SONGS,
        "mart_listening_patterns_wide": wide + MART_LISTENING_PATTERNS,
        "fact_song_stream_wide": wide + CELLS_OUT,
        "fact_two_batches_wide": wide + CELLS_OUT,
        "fact_batch_replay_wide": wide + CELLS_OUT,
        "fact_compacted_wide": wide + CELLS_OUT,
        "key_resolution_wide": wide + CELLS_OUT,
        "dim_first_wins_wide": first_wins_wide
        + "\nSELECT song_natural_key, song_title, duration_ms FROM dim_song",
        "rejected_plays_wide": _with(LINEITEM_FEED, _plays(
            source="(SELECT * FROM feed WHERE CAST(substr(song_natural_key, 2) AS BIGINT) % 5 = 0)")) + """
SELECT play_id, song_title, artist_name, song_duration_ms FROM plays""",
        "dq_suite_wide": _suite(broken=False, feed=LINEITEM_FEED),
        "dim_song_wide": wide + "\nSELECT song_natural_key, song_title, duration_ms FROM dim_song",
    }
