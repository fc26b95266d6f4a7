"""Plays that several fetches return count once."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from cadence.operators.star import compact, fact_song_stream, fold, load_star, vacuum
from cadence.operators.clean import clean_plays
from cadence.sources.warehouse import Warehouse
from tests.conftest import staged_df


def plays(spark, *rows):
    return clean_plays(staged_df(spark, [("t", "x", f"2026-{at}", "10", "a1", s) for at, s in rows]))


def count(wh):
    return fact_song_stream(wh).agg(F.sum("play_count")).first()[0]


def test_overlapping_batches_add_each_play_once(spark, warehouse):
    first = plays(spark, ("05-25T22:00:00Z", "s1"), ("05-25T22:00:00Z", "s2"), ("05-31T23:59:59Z", "s1"),
                  ("05-31T23:59:59Z", "s1"))
    load_star(warehouse, first, "b1", identity=True)
    assert count(warehouse) == 3
    second = plays(spark, ("05-31T23:59:59Z", "s1"), ("06-01T00:00:00Z", "s1"), ("05-25T22:00:00.000001Z", "s1"))
    load_star(warehouse, second, "b2", identity=True)
    assert count(warehouse) == 5
    # Replays compare with the other batches, folded or not.
    load_star(warehouse, second, "b2", identity=True)
    assert count(warehouse) == 5
    fold(warehouse, keep_pending=0)
    load_star(warehouse, second, "b3", identity=True)
    assert count(warehouse) == 5
    compact(warehouse)
    vacuum(warehouse, keep_versions=1, orphan_hours=0)
    load_star(warehouse, first, "b4", identity=True)
    load_star(warehouse, plays(spark, ("06-01T00:00:00Z", "s2")), "b5", identity=True)
    assert count(warehouse) == 6


def test_listeners_have_plays_of_their_own(spark, warehouse):
    one = plays(spark, ("05-25T22:00:00Z", "s1"))
    for number, listener in enumerate(("u1", "u2", "u1", None, None)):
        load_star(warehouse, one.withColumn("listener", F.lit(listener).cast("string")), f"b{number}", identity=True)
    assert count(warehouse) == 3


def test_loads_without_identities_stay_as_they_are(spark, warehouse):
    p = plays(spark, ("05-25T22:00:00Z", "s1"), ("05-25T22:00:00Z", "s1"))
    load_star(warehouse, p, "b1")
    load_star(warehouse, p, "b2", identity=True)
    load_star(warehouse, p, "b3", identity=True)
    assert count(warehouse) == 3


def test_plays_without_a_song_are_still_rejected(spark, warehouse):
    p = plays(spark, ("05-25T22:00:00Z", "s1"), ("05-25T22:00:00Z", None), ("05-25T22:00:00Z", None))
    assert load_star(warehouse, p, "b1", fail_on_reject=False, identity=True).rejected_plays == 2
    assert count(warehouse) == 1


def test_concurrent_loads_of_the_same_plays_add_them_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    p = plays(spark, *[("05-25T22:00:00Z", f"s{i}") for i in range(4)])
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda b: load_star(wh, p, b, identity=True), ["b1", "b2", "b3"]))
    assert count(wh) == 4
