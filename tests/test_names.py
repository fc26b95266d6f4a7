"""Other sessions read the warehouse by name, at the newest published commit."""

import uuid

import pytest

from cadence.operators.clean import clean_plays
from cadence.operators.star import compact, dim_table, fact_song_stream, load_star
from cadence.plans.models import MART_NAMES, build_models, staging_models
from cadence.sources.names import publish_names
from tests.conftest import staged_df


def plays(spark, *rows):
    return clean_plays(staged_df(spark, [(f"t {s}", "x", f"2026-{d}T22:00:00Z", ms, "a1", s) for d, s, ms in rows]))


@pytest.fixture()
def database(spark):
    name = f"names_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_another_session_reads_every_name_at_the_newest_commit(spark, warehouse, database):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")

    def assert_same():
        named = lambda t: rows(other.table(f"{database}.{t}"))
        for t in ("dim_artist", "dim_song", "dim_date"):
            assert other.table(f"{database}.{t}").columns == dim_table(warehouse, t).columns
            assert named(t) == rows(dim_table(warehouse, t))
        assert named("fact_song_stream") == rows(fact_song_stream(warehouse))
        models = staging_models(warehouse)
        for t in ("stg_streams", "stg_songs", "stg_artists", "stg_dates"):
            assert named(t) == rows(getattr(models, t))
        for t in MART_NAMES:
            assert named(t) == rows(warehouse.read_model(t))

    load_star(warehouse, plays(spark, ("05-01", "s1", "61500"), ("06-01", "s1", "0")), "b1")
    build_models(warehouse)
    publish_names(warehouse, database)
    assert_same()
    load_star(warehouse, plays(spark, ("05-01", "s1", "30300"), ("05-02", "s2", "7")), "b2")
    # An attempt that no commit names is not seen.
    dim_table(warehouse, "dim_song").write.parquet(warehouse.attempt_path("dim_song", "lost"))
    build_models(warehouse)
    assert publish_names(warehouse, database) == warehouse.state().version
    assert_same()
    compact(warehouse)
    publish_names(warehouse, database)
    assert_same()
    assert other.sql(f"SELECT sum(total_plays) AS n FROM {database}.mart_top_songs").first().n == 3


def test_dropping_names_deletes_no_data(spark, warehouse, database):
    load_star(warehouse, plays(spark, ("05-01", "s1", "1")), "b1")
    build_models(warehouse)
    publish_names(warehouse, database)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert fact_song_stream(warehouse).count() == 1 and warehouse.read_model("mart_top_songs").count() == 1
    publish_names(warehouse, database)
    assert spark.table(f"{database}.fact_song_stream").count() == 1


def test_names_of_an_empty_warehouse(spark, warehouse, database):
    publish_names(warehouse, database)
    assert spark.table(f"{database}.stg_streams").count() == 0
    with pytest.raises(ValueError):
        publish_names(warehouse, "a b; drop")
