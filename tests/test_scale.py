"""What keeps a task's memory, spills and shuffles in proportion to the input."""

import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cadence.operators.star import load_star
from cadence.plans import mart_parts
from cadence.plans.mart_parts import mart_from_parts, refresh_parts
from cadence.plans.models import mart_listening_patterns
from cadence.session import SPLIT_BYTES, delete_path, ensure_conf, materialise
from tests.test_tiers import assert_same_marts, plays


def test_splits_are_bounded_unless_the_caller_set_them(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        ensure_conf(spark)
        assert int(spark.conf.get(key)) == SPLIT_BYTES
        spark.conf.set(key, "65536")
        ensure_conf(spark)
        assert spark.conf.get(key) == "65536"
    finally:
        spark.conf.set(key, before)


def test_a_stored_layer_is_read_in_several_splits(spark):
    rows = spark.range(4_000_000, numPartitions=1).select(F.xxhash64("id").alias("h"))
    stored, path = materialise(rows, "layer", small=True)
    assert stored.rdd.getNumPartitions() > 1
    groups = [pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in stored.inputFiles()]
    assert max(groups) > 1 and stored.count() == 4_000_000
    delete_path(spark, path)


def test_patterns_sum_the_fact_once(spark, capsys):
    streams = spark.range(40).select((F.col("id") % 4).alias("date_id"), (F.col("id") % 5).alias("song_id"),
                                     F.lit(1).cast("bigint").alias("play_count"),
                                     F.lit("0.25").cast("decimal(10,2)").alias("total_duration_minutes"))
    dates = spark.range(4).select(F.col("id").alias("date_id"), F.concat(F.lit("day "), (F.col("id") % 2).cast("string")).alias("day_of_week"),
                                  (F.col("id") % 2).cast("int").alias("hour_of_day"))
    mart = mart_listening_patterns(streams, dates)
    assert [(r.hour_of_day, r.total_plays, float(r.total_minutes), r.unique_songs) for r in mart.collect()] == [
        (0, 20, 5.0, 5), (1, 20, 5.0, 5)]
    capsys.readouterr()
    mart.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(day_of_week" in plan and not re.search(r"hashpartitioning\(date_id#\w+, song_id", plan)


def test_parts_hold_no_more_words_than_cells(spark, tmp_path, monkeypatch):
    from cadence.sources.warehouse import Warehouse

    monkeypatch.setattr(mart_parts, "DEALT_TOGETHER", 7)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_star(wh, plays(spark, *[(f"2026-{5 + i % 2:02d}-01", f"a{i % 30}", 60000 + i) for i in range(60)]), "b1")
    state = refresh_parts(wh)
    artists = mart_parts.read_parts(wh, state, "parts_artists")
    words = artists.select(F.sum(F.size("songs"))).first()[0]
    assert 0 < words <= mart_parts.read_parts(wh, state, "parts_songs").count()
    assert_same_marts(wh)
    assert mart_from_parts(wh, state, "mart_listening_patterns").count() > 0
