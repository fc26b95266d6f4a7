"""SQL names that outlive a session (S6, K5): catalog tables over committed attempts.

``publish_names`` gives a database of the session's catalog one name for each star
table, staging view and published mart.  Star tables are external tables whose
partitions are the committed attempts, nothing is copied, and attempts that no
commit names are no partitions.  Names on top of them are views:

    dim_artist, dim_song, dim_date     the dimension rows
    fact_song_stream                   cells summed over attempts, with their ids
    stg_streams, stg_songs, stg_artists, stg_dates
    mart_*                             the published attempts

It compares what the catalog names with the newest commit and changes the
difference, so it is cheap to call after each commit, and dropping a name or the
database deletes no data.  With a shared metastore other sessions and applications
read the tables by name; views of a former version go on as long as ``vacuum``
leaves its attempts.
"""

from __future__ import annotations

import re

from cadence.schemas import STAR_TABLES
from cadence.sources.warehouse import ATTEMPT, DIM_TABLES, FACT, State, Warehouse

NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
FACT_COLUMNS = ("date_id", "song_id", "artist_id", "play_count", "total_duration")
# The views on the star tables; minutes and ids as functions/measures.py and keys.py define them.
VIEWS = {
    **{t: f"SELECT {', '.join(STAR_TABLES[t].names)} FROM {{db}}.attempts_{t}" for t in DIM_TABLES},
    FACT: f"""SELECT unhex(md5(CAST(concat_ws(':', CAST(date_id AS STRING), CAST(song_id AS STRING),
                CAST(artist_id AS STRING)) AS BINARY))) AS song_stream_id, * FROM (
              SELECT date_id, song_id, artist_id, sum(play_count) AS play_count, sum(total_duration) AS total_duration
              FROM {{db}}.attempts_{FACT} GROUP BY date_id, song_id, artist_id)""",
    "stg_streams": f"""SELECT song_stream_id, song_id, artist_id, date_id, play_count, total_duration,
                         round(total_duration / 60000.0, 2) AS total_duration_minutes
                       FROM {{db}}.{FACT} WHERE play_count > 0 AND total_duration > 0""",
    "stg_songs": """SELECT song_id, song_natural_key, song_title, duration_ms,
                      round(duration_ms / 60000.0, 2) AS duration_minutes FROM {db}.dim_song""",
    "stg_artists": "SELECT artist_id, artist_natural_key, artist_name FROM {db}.dim_artist",
    "stg_dates": "SELECT date_id, hour_of_day, day_of_week, month, year FROM {db}.dim_date",
}


def _partitions(state: State) -> dict[str, set[str]]:
    """table -> the partition folders that count."""
    out = {t: {f"{ATTEMPT}={a}" for a in state.dims.get(t, [])} for t in DIM_TABLES}
    out[FACT] = {f"{ATTEMPT}={a}/year={int(m[:4])}/month={int(m[5:])}"
                 for m, found in state.sources().items() for a in found}
    return out


def _spec(folder: str) -> str:
    pairs = [p.split("=", 1) for p in folder.split("/")]
    return ", ".join(f"{k}='{v}'" if k == ATTEMPT else f"{k}={v}" for k, v in pairs)


def publish_names(warehouse: Warehouse, database: str) -> int:
    """Bring the names in ``database`` to the newest commit; return its version."""
    if not NAME.fullmatch(database):
        raise ValueError(f"invalid database name {database!r}")
    spark, state = warehouse.spark, warehouse.state()
    warehouse.create_tables()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, wanted in _partitions(state).items():
        name, path = f"{database}.attempts_{table}", warehouse.table_path(table)
        fields = [f for f in STAR_TABLES[table].fields if table != FACT or f.name in FACT_COLUMNS]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        parts = f"{ATTEMPT} string" + (", year int, month int" if table == FACT else "")
        by = ", ".join(p.split()[0] for p in parts.split(", "))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {parts}) USING parquet "
                  f"PARTITIONED BY ({by}) LOCATION '{path}'")
        held = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        added = " ".join(f"PARTITION ({_spec(f)}) LOCATION '{path}/{f}'" for f in sorted(wanted - held))
        if added:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        gone = ", ".join(f"PARTITION ({_spec(f)})" for f in sorted(held - wanted))
        if gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    for view, text in VIEWS.items():
        if not spark.catalog.tableExists(f"{database}.{view}"):
            spark.sql(f"CREATE VIEW {database}.{view} AS {text.format(db=database)}")
    for mart, attempt in state.models.items():
        # A table for each build and a view on the published one: sessions that have
        # read the view before look its table up again.
        build, path = re.sub(r"\W", "_", f"{mart}__{attempt}"), warehouse.attempt_path(f"marts/{mart}", attempt)
        # The columns come from the stored files.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{build} USING parquet LOCATION '{path}'")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{mart} AS SELECT * FROM {database}.{build}")
        for old in spark.sql(f"SHOW TABLES IN {database} LIKE '{mart}__*'").collect():
            if old.tableName != build.lower():
                spark.sql(f"DROP TABLE IF EXISTS {database}.{old.tableName}")
    return state.version
