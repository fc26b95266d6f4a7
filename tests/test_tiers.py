"""Upkeep without a command, marts by change, and retries after folding."""

import random

import pytest
from pyspark.sql import functions as F

from cadence.operators import star
from cadence.operators.clean import clean_plays
from cadence.operators.star import BatchAlreadyCompacted, compact, fact_song_stream, fold, load_star, stays_apart
from cadence.plans import mart_parts
from cadence.plans.batch_job import run_batch_job
from cadence.plans.mart_parts import build_marts_by_change, changed_months, mart_from_parts, refresh_parts
from cadence.plans.models import MART_NAMES, staging_models
from cadence.sources import raw_json
from cadence.sources.feed import event_plays
from cadence.sources.warehouse import NUMBERS, State, Warehouse
from tests.conftest import SF_SMALL, staged_df


def plays(spark, *rows):
    """Rows of (day, song, milliseconds); a song's artist is its first letter."""
    return clean_plays(staged_df(spark, [
        (f"title {s}", f"artist {s[0]}", f"{day}T22:00:00Z", str(ms), s[0], s) for day, s, ms in rows]))


def totals(wh):
    r = fact_song_stream(wh).agg(F.sum("play_count").alias("n"), F.sum("total_duration").alias("ms")).first()
    return r.n, r.ms


def test_attempts_that_stay_fall_by_the_ratio():
    assert [stays_apart(x) for x in ([], [5], [100, 1], [4, 1], [5, 1], [1000, 100, 10, 1], [1000, 3, 9, 2])] == \
        [0, 0, 1, 0, 1, 3, 1]
    rng = random.Random(1)
    sizes, rewritten, total = [], 0, 0
    for _ in range(5000):
        n = rng.choice([1, 1, 1, 7, 40])
        total += n
        sizes.append(n)
        kept = stays_apart(sizes)
        if len(sizes) - kept > 1:
            rewritten += sum(sizes[kept:])
        sizes = sizes[:kept] + [sum(sizes[kept:])]
        # At most one more than the logarithm of the rows, and each row is rewritten as seldom.
        assert len(sizes) <= 1 + total.bit_length()
    assert sum(sizes) == total and rewritten < 12 * total


def test_loads_fold_older_ones_and_the_state_stays_small(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), keep_pending=1)
    want = 0
    for number in range(9):
        load_star(wh, plays(spark, ("2026-05-01", "a1", 1), (f"2026-0{1 + number % 2}-03", f"b{number}", 10)), f"b{number}")
        want += 11
        state = wh.state()
        assert len(state.facts) <= 2 and all(len(x) <= 4 for x in state.sources().values())
        assert totals(wh) == (2 * number + 2, want)
        assert sum(state.rows[f"{NUMBERS}/{a}"] for a in state.dims[NUMBERS]) == number + 2
    assert sorted(r.number for r in wh.read_dim(NUMBERS).collect()) == list(range(10))
    # The newest load can be replaced, a folded one can't.
    load_star(wh, plays(spark, ("2026-05-01", "a1", 5)), "b8")
    assert totals(wh) == (17, want - 6)
    with pytest.raises(BatchAlreadyCompacted):
        load_star(wh, plays(spark, ("2026-05-01", "a1", 5)), "b0")


def test_a_late_play_does_not_rewrite_an_old_month(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_star(wh, plays(spark, *[("2026-05-01", f"a{i}", 1) for i in range(40)]), "big")
    fold(wh, keep_pending=0)
    big = wh.state().months["2026-05"]
    for number in range(3):
        load_star(wh, plays(spark, ("2026-05-02", "a1", 1)), f"late{number}")
        fold(wh, keep_pending=0)
        assert wh.state().months["2026-05"] == big and len(wh.state().runs["2026-05"]) == 1
    assert totals(wh) == (43, 43)
    compact(wh)
    assert not wh.state().runs and totals(wh) == (43, 43)


def test_a_fold_that_lost_a_race_changes_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for b in ("b1", "b2"):
        load_star(wh, plays(spark, ("2026-05-01", "a1", 1)), b)
    state = wh.state()
    load_star(wh, plays(spark, ("2026-05-01", "a1", 7)), "b1")
    assert star._fold(wh, state, ["b1", "b2"], False) is None
    assert totals(wh) == (2, 8)


def test_states_of_the_former_layout_are_read(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for b in ("b1", "b2"):
        load_star(wh, plays(spark, ("2026-05-01", "a1", 1), ("2026-05-01", b, 1)), b)
    state = wh.state()
    old = {b: {"attempt": f["attempt"], "months": sorted(f["months"])} for b, f in state.facts.items()}
    wh.try_commit(state, facts=old, rows={}, dims={t: a for t, a in state.dims.items() if t != NUMBERS})
    assert fold(wh, keep_pending=0) and totals(wh) == (4, 4)
    build_marts_by_change(wh)
    assert wh.read_model("mart_top_songs").agg(F.sum("total_plays")).first()[0] == 4
    assert sorted(r.number for r in wh.read_dim(NUMBERS).collect()) == [0, 1, 2]


def assert_same_marts(wh):
    state = wh.state()
    assert not changed_months(state)
    for name in MART_NAMES:
        got, want = mart_from_parts(wh, state, name), staging_models(wh).mart(name)
        assert got.columns == want.columns
        assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))


def test_marts_by_change_equal_the_whole_build_and_read_changed_months_only(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    read = []
    real = mart_parts.fact_cells
    monkeypatch.setattr(mart_parts, "fact_cells", lambda w, s, months: read.append(months) or real(w, s, months))
    load_star(wh, plays(spark, ("2026-04-01", "a1", 30300), ("2026-04-02", "a2", 61500), ("2026-05-01", "a1", 214357),
                        ("2026-05-08", "b1", 0)), "b1")
    build_marts_by_change(wh)
    assert read == [["2026-04", "2026-05"]]
    assert_same_marts(wh)
    load_star(wh, plays(spark, ("2026-05-01", "b2", 500), ("2026-06-01", "a1", 30300)), "b2")
    assert changed_months(wh.state()) == ["2026-05", "2026-06"]
    build_marts_by_change(wh)
    assert read[1:] == [["2026-05", "2026-06"]]
    assert_same_marts(wh)
    # A smaller replay takes a month away; folding changes no cell and no part.
    load_star(wh, plays(spark, ("2026-05-01", "b2", 500)), "b2")
    refresh_parts(wh)
    assert "2026-06" not in wh.state().parts and read[2:] == [["2026-05"]]
    assert_same_marts(wh)
    compact(wh)
    refresh_parts(wh)
    assert len(read) == 3
    assert_same_marts(wh)


def test_parts_scan_no_other_month(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_star(wh, plays(spark, ("2026-04-01", "a1", 1), ("2026-05-01", "a1", 1)), "b1")
    files = star.fact_cells(wh, wh.state(), ["2026-05"]).inputFiles()
    assert files and all("month=5" in f for f in files)


def test_numbers_have_no_gaps_when_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(star, "NUMBERED_TOGETHER", 7)
    songs = spark.range(100).select((F.col("id") * 7919 - 300).alias("song_id"))
    assert sorted(r.number for r in star.numbered(songs, 100).collect()) == list(range(100))


def test_bitmaps_span_buckets(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_star(wh, plays(spark, *[("2026-05-01", f"a{i}", 60000) for i in range(6)]), "b1")
    state = wh.state()
    # Numbers on both sides of the buckets' edges.
    ids = wh.read_dim(NUMBERS).select("song_id", F.element_at(
        F.array(*[F.lit(n) for n in (0, 1, 32766, 32767, 32768, 70000)]), (F.col("number") + 1).cast("int")).cast(
        "bigint").alias("number"))
    ids.write.parquet(wh.attempt_path(NUMBERS, "spread"))
    wh.try_commit(state, dims=state.dims | {NUMBERS: ["spread"]}, rows=state.rows | {f"{NUMBERS}/spread": 6})
    state = refresh_parts(wh)
    assert mart_from_parts(wh, state, "mart_top_artists").first().unique_songs == 6
    assert mart_parts.read_parts(wh, state, "parts_artists").count() == 3


def test_marts_of_an_empty_warehouse(spark, warehouse):
    build_marts_by_change(warehouse)
    assert all(warehouse.read_model(n).count() == 0 for n in MART_NAMES)
    assert State.signature(["b", "a"]) == State.signature(["a", "b"]) != State.signature(["a"])


def test_the_job_may_be_retried_after_folding(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    source = event_plays(spark, SF_SMALL)
    raw_json.write_raw_pages(raw_json.to_raw_pages(source), landing)
    run_batch_job(spark, landing, root, "d1")
    compact(Warehouse(spark, root))
    version = Warehouse(spark, root).state().models
    run_batch_job(spark, landing, root, "d1")
    wh = Warehouse(spark, root)
    assert totals(wh)[0] == 1000 and wh.state().models != version
    # Other plays under a folded id are no retry.
    raw_json.write_raw_pages(raw_json.to_raw_pages(source.where("play_id % 2 = 0")), landing)
    with pytest.raises(BatchAlreadyCompacted, match="other plays"):
        run_batch_job(spark, landing, root, "d1")


def test_one_line_csv_is_read_in_several_tasks(spark, tmp_path):
    from cadence.sources import csv_files
    staged = spark.range(4000).select(*[F.concat(F.lit(f"{c} "), "id").alias(c) for c in (
        "song_title", "artist_name", "played_at", "song_duration_ms", "artist_natural_key", "song_natural_key")])
    csv_files.save_staging(staged.coalesce(1), str(tmp_path / "s"), fmt="csv")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        parts = {m: csv_files.read_staging(spark, str(tmp_path / "s"), fmt="csv", multiline=m).rdd.getNumPartitions()
                 for m in (True, False)}
        same = csv_files.read_staging(spark, str(tmp_path / "s"), fmt="csv", multiline=False).count()
    finally:
        spark.conf.set(key, before)
    assert parts[True] == 1 < parts[False] and same == 4000
