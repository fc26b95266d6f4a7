import json

import pytest
from pyspark.sql import functions as F

from cadence.operators.checks import ChecksFailed, assert_checks, run_checks
from cadence.operators.clean import clean_plays
from cadence.operators.star import dim_table, fact_song_stream, load_star
from cadence.plans.batch_job import run_batch_job
from cadence.plans.catalog import cleaned_feed
from cadence.plans.models import staging_models
from cadence.sources import raw_json
from cadence.sources.feed import event_plays
from cadence.sources.warehouse import Warehouse
from cadence.streaming.incremental import run_incremental
from tests.conftest import SF_SMALL, staged_df


def _tables(wh):
    m = staging_models(wh)
    return {"stg_streams": m.stg_streams, "stg_songs": m.stg_songs, "stg_artists": m.stg_artists,
            "dim_artist": dim_table(wh, "dim_artist"), "dim_song": dim_table(wh, "dim_song"),
            "dim_date": dim_table(wh, "dim_date"), "fact_song_stream": fact_song_stream(wh)}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    load_star(wh, cleaned_feed(spark, SF_SMALL), "b1")
    return wh


def test_checks_pass_on_good_data(loaded):
    res = run_checks(_tables(loaded))
    rows = {r.check_id: r.failures for r in res.collect()}
    assert len(rows) == 16 and set(rows.values()) == {0}
    assert_checks(res)


@pytest.mark.parametrize("check_id,table,breaker", [
    ("D1", "stg_streams", lambda df: df.unionByName(df.limit(1))),
    ("D2", "stg_streams", lambda df: df.withColumn("song_stream_id", F.lit(None).cast("long"))),
    ("D3", "stg_streams", lambda df: df.withColumn("play_count", F.lit(None).cast("long"))),
    ("D4", "stg_streams", lambda df: df.withColumn("total_duration", F.lit(None).cast("long"))),
    ("D5", "stg_artists", lambda df: df.unionByName(df)),
    ("D6", "stg_artists", lambda df: df.withColumn("artist_id", F.lit(None).cast("long"))),
    ("D7", "stg_artists", lambda df: df.withColumn("artist_name", F.lit(None).cast("string"))),
    ("D8", "stg_songs", lambda df: df.unionByName(df)),
    ("D9", "stg_songs", lambda df: df.withColumn("song_id", F.lit(None).cast("long"))),
    ("D10", "stg_songs", lambda df: df.withColumn("song_title", F.lit(None).cast("string"))),
    ("D11a", "dim_artist", lambda df: df.unionByName(df.withColumn("artist_id", F.lit(1).cast("long")))),
    ("D11b", "dim_song", lambda df: df.unionByName(df)),
    ("D11c", "dim_date", lambda df: df.unionByName(df)),
    ("D12a", "fact_song_stream", lambda df: df.withColumn("date_id", F.col("date_id") + 1)),
    ("D12b", "fact_song_stream", lambda df: df.withColumn("song_id", F.col("song_id") + 1)),
    ("D12c", "fact_song_stream", lambda df: df.withColumn("artist_id", F.col("artist_id") + 1)),
])
def test_each_check_catches_its_breakage(loaded, check_id, table, breaker):
    t = _tables(loaded)
    t[table] = breaker(t[table])
    res = {r.check_id: r.failures for r in run_checks(t).collect()}
    assert res[check_id] > 0
    with pytest.raises(ChecksFailed, match=check_id):
        assert_checks(run_checks(t))


def _land(spark, path, plays):
    raw_json.write_raw_pages(raw_json.to_raw_pages(plays), path)


def test_batch_job_end_to_end(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(spark, landing, event_plays(spark, SF_SMALL))
    for fmt in ("parquet", "csv"):
        res = run_batch_job(spark, landing, str(tmp_path / f"wh-{fmt}"), "2024-01-31", fmt=fmt)
        assert {r.failures for r in res.checks.collect()} == {0}
        wh = Warehouse(spark, str(tmp_path / f"wh-{fmt}"))
        marts = wh.read_model("mart_top_artists")
        assert marts.agg(F.sum("total_plays")).first()[0] == 1000
    # Replay of the same batch id leaves the totals unchanged.
    run_batch_job(spark, landing, str(tmp_path / "wh-parquet"), "2024-01-31")
    wh = Warehouse(spark, str(tmp_path / "wh-parquet"))
    assert wh.read_model("mart_top_artists").agg(F.sum("total_plays")).first()[0] == 1000


def test_batch_job_window_and_cap(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(spark, landing, event_plays(spark, SF_SMALL))
    plays = event_plays(spark, SF_SMALL)
    in_day = plays.where(F.col("played_at") > F.lit("2024-01-29 23:59:59").cast("timestamp")).count()
    res = run_batch_job(spark, landing, str(tmp_path / "wh"), "b1", as_of="2024-01-30 23:59:59.9")
    assert res.models.stg_streams.agg(F.sum("play_count")).first()[0] == in_day
    res = run_batch_job(spark, landing, str(tmp_path / "wh2"), "b1",
                        as_of="2024-01-30 23:59:59", latest_cap=in_day // 2)
    assert res.models.stg_streams.agg(F.sum("play_count")).first()[0] == in_day // 2


def test_incremental_equals_batch(spark, tmp_path):
    plays = event_plays(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    ts = F.col("played_at")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    _land(spark, f"{landing}/a", plays.where(ts < cut))
    _land(spark, f"{landing}/b", plays.where(ts >= cut))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ckpt = str(tmp_path / "ckpt")
    run_incremental(spark, landing, wh, ckpt, max_files_per_trigger=1)
    assert len([b for b in wh.state().facts if b.startswith("stream-")]) >= 2
    streamed = sorted(map(tuple, staging_models(wh).mart("mart_top_artists").collect()))

    ref = Warehouse(spark, str(tmp_path / "ref"))
    load_star(ref, cleaned_feed(spark, SF_SMALL), "b1")
    assert streamed == sorted(map(tuple, staging_models(ref).mart("mart_top_artists").collect()))

    # New files arrive later: only they are processed.
    _land(spark, f"{landing}/c", plays.where(ts < cut))
    run_incremental(spark, landing, wh, ckpt)
    total = fact_song_stream(wh).agg(F.sum("play_count")).first()[0]
    assert total == 1000 + plays.where(ts < cut).count()


def test_empty_micro_batch_is_noop(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "p.json").write_text(json.dumps({"items": []}) + "\n")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run_incremental(spark, str(landing), wh, str(tmp_path / "ckpt"))
    assert fact_song_stream(wh).count() == 0


def test_first_wins_across_batches(spark, warehouse):
    a = clean_plays(staged_df(spark, [("first", "x", "2026-05-25T22:00:00Z", "1000", "a1", "s1")]))
    b = clean_plays(staged_df(spark, [("second", "x", "2026-05-26T22:00:00Z", "2000", "a1", "s1")]))
    load_star(warehouse, a, "b1")
    load_star(warehouse, b, "b2")
    load_star(warehouse, a, "b1")        # replaying the first batch keeps it first
    assert [(r.song_title, r.duration_ms) for r in dim_table(warehouse, "dim_song").collect()] \
        == [("first", 1000)]


def test_command_line_batch_and_compact(spark, tmp_path):
    from cadence.__main__ import main
    landing = str(tmp_path / "landing")
    _land(spark, landing, event_plays(spark, SF_SMALL))
    wh_root = str(tmp_path / "wh")
    assert main(["run-batch", "--raw", landing, "--warehouse", wh_root, "--batch-id", "d1"]) == 0
    assert main(["compact", "--warehouse", wh_root, "--vacuum-keep", "1"]) == 0
    # marts are registered for SQL after a build
    assert spark.sql("SELECT sum(total_plays) AS n FROM mart_top_artists").first().n == 1000
    assert spark.sql("SELECT count(*) AS n FROM stg_streams").first().n > 0
    assert fact_song_stream(Warehouse(spark, wh_root)).agg(F.sum("play_count")).first()[0] == 1000


def test_redelivered_micro_batch_is_idempotent(spark, tmp_path):
    """foreachBatch is at-least-once: the same epoch handled twice changes nothing,
    also after it has been compacted."""
    from cadence.operators.star import compact
    from cadence.sources.feed import as_staged
    from cadence.streaming.incremental import upsert_batch
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_tables()
    staged = as_staged(event_plays(spark, SF_SMALL)).drop("play_id")
    handle = upsert_batch(wh, lambda: "q1")
    handle(staged, 7)
    first = sorted(map(tuple, fact_song_stream(wh).collect()))
    handle(staged, 7)
    assert sorted(map(tuple, fact_song_stream(wh).collect())) == first
    compact(wh)
    handle(staged, 7)
    assert sorted(map(tuple, fact_song_stream(wh).collect())) == first
    # Another stream's epoch 7 is another batch.
    upsert_batch(wh, lambda: "q2")(staged, 7)
    assert fact_song_stream(wh).agg(F.sum("play_count")).first()[0] == 2000
    assert not wh.list_dir(f"{wh.root}/_scratch")


def _land_songs(spark, path, songs):
    items = [{"played_at": "2026-05-25T22:00:00Z", "track": {
        "name": s, "id": s, "duration_ms": 60000, "artists": [{"id": "a", "name": "x"}]}} for s in songs]
    path.mkdir(parents=True, exist_ok=True)
    for i, item in enumerate(items):
        (path / f"{songs[0]}-{i}.json").write_text(json.dumps({"items": [item]}) + "\n")


def test_two_streams_into_one_warehouse_add_up(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    _land_songs(spark, tmp_path / "a", ["s1", "s2", "s3"])
    _land_songs(spark, tmp_path / "b", ["s1"])
    for name in ("a", "b"):
        run_incremental(spark, str(tmp_path / name), wh, str(tmp_path / f"ckpt-{name}"))
    assert fact_song_stream(wh).agg(F.sum("play_count")).first()[0] == 4


def test_a_time_limit_raises_and_the_next_run_loads_the_rest(spark, tmp_path):
    from cadence.streaming.incremental import StreamNotFinished
    wh = Warehouse(spark, str(tmp_path / "wh"))
    _land_songs(spark, tmp_path / "a", [f"s{i}" for i in range(6)])
    with pytest.raises(StreamNotFinished, match="unread"):
        run_incremental(spark, str(tmp_path / "a"), wh, str(tmp_path / "ckpt"), max_files_per_trigger=1, limit_s=1)
    run_incremental(spark, str(tmp_path / "a"), wh, str(tmp_path / "ckpt"))
    assert fact_song_stream(wh).agg(F.sum("play_count")).first()[0] == 6


def test_retry_with_as_of_takes_the_same_plays(spark, tmp_path):
    landing = str(tmp_path / "landing")
    plays = event_plays(spark, SF_SMALL)
    day = lambda d: plays.where(F.to_date("played_at") == F.lit(d).cast("date"))
    root, as_of = str(tmp_path / "wh"), "2024-01-10 23:59:59.999999"
    total = lambda: fact_song_stream(Warehouse(spark, root)).agg(F.sum("play_count")).first()[0]
    _land(spark, f"{landing}/d1", day("2024-01-10"))
    run_batch_job(spark, f"{landing}/*", root, "d1", as_of=as_of)
    first = total()
    _land(spark, f"{landing}/d2", day("2024-01-11"))
    run_batch_job(spark, f"{landing}/*", root, "d1", as_of=as_of)      # retried after day 2 has landed
    assert total() == first == day("2024-01-10").count()
    run_batch_job(spark, f"{landing}/*", root, "d2", as_of="2024-01-11 23:59:59.999999")
    assert total() == first + plays.where((F.col("played_at") > F.lit("2024-01-10 23:59:59").cast("timestamp")) & (
        F.to_date("played_at") <= F.lit("2024-01-11").cast("date"))).count()


def test_cap_with_ties_picks_the_same_plays(spark, tmp_path):
    _land_songs(spark, tmp_path / "a", [f"s{i}" for i in range(12)])
    picked = []
    for n in range(2):
        res = run_batch_job(spark, str(tmp_path / "a"), str(tmp_path / f"wh{n}"), "b1", latest_cap=5)
        picked.append(sorted(r.song_natural_key for r in res.models.stg_songs.collect()))
    assert len(picked[0]) == 5 and picked[0] == picked[1]


def test_bad_dates_fail_the_window_and_missing_ones_do_not(spark):
    rows = [("t", "x", d, "1", "a", "s") for d in ("2026-05-25T22:00:00Z", "N/A", None)]
    assert raw_json.recent_window(staged_df(spark, rows), "2026-05-25 23:00:00").count() == 1
    with pytest.raises(Exception, match="not-a-date"):
        raw_json.recent_window(staged_df(spark, [("t", "x", "not-a-date", "1", "a", "s")]), "2026-05-25").collect()


def test_jobs_leave_no_scratch_folder(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(spark, landing, event_plays(spark, SF_SMALL))
    root = str(tmp_path / "wh")
    for b in ("d1", "d2"):
        run_batch_job(spark, landing, root, b)
    wh = Warehouse(spark, root)
    assert not wh.list_dir(f"{root}/_scratch")
    assert wh.read_model("mart_top_artists").agg(F.sum("total_plays")).first()[0] == 2000


def test_one_job_sums_the_fact_once(spark, tmp_path, monkeypatch):
    from cadence.plans import models
    calls = []
    real = models.fact_song_stream
    monkeypatch.setattr(models, "fact_song_stream", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(models, "register_views", lambda m: None)
    landing = str(tmp_path / "landing")
    _land(spark, landing, event_plays(spark, SF_SMALL))
    from cadence.plans import batch_job
    monkeypatch.setattr(batch_job, "register_all", lambda wh: None)
    run_batch_job(spark, landing, str(tmp_path / "wh"), "d1")
    assert len(calls) == 1


def test_failed_checks_leave_the_old_marts(spark, tmp_path, monkeypatch):
    from cadence.plans import batch_job
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    _land(spark, landing, event_plays(spark, SF_SMALL))
    run_batch_job(spark, landing, root, "d1")
    real = batch_job.run_checks
    monkeypatch.setattr(batch_job, "run_checks", lambda t: real(t | {"dim_song": t["dim_song"].unionByName(t["dim_song"])}))
    with pytest.raises(ChecksFailed, match="D11b"):
        run_batch_job(spark, landing, root, "d2")
    assert Warehouse(spark, root).read_model("mart_top_artists").agg(F.sum("total_plays")).first()[0] == 1000


def test_no_checkpoint_folder_on_a_cluster_is_an_error():
    from types import SimpleNamespace

    from cadence.session import checkpoint_root
    conf = SimpleNamespace(get=lambda k, d=None: None)
    sc = SimpleNamespace(master="yarn", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))


def test_absent_and_null_durations_differ(spark, tmp_path):
    def item(**track):
        return {"played_at": "2026-05-25T22:00:00Z", "track": {"name": "n", "id": "s", "artists": [], **track}}
    lines = [{"items": [item(), item(duration_ms=None), item(duration_ms=5)]}]
    (tmp_path / "p.json").write_text("".join(json.dumps(x) + "\n" for x in lines))
    got = raw_json.read_staged_from_json(spark, str(tmp_path)).collect()
    assert [r.song_duration_ms for r in got] == [0, None, 5]


def test_resolve_keys_aborts_on_missing_key(spark, loaded):
    from cadence.operators.star import resolve_keys
    plays = cleaned_feed(spark, SF_SMALL)
    artists = dim_table(loaded, "dim_artist").where(F.col("artist_natural_key") != "a3")
    with pytest.raises(Exception, match="natural key not found"):
        resolve_keys(plays, artists, dim_table(loaded, "dim_song"), dim_table(loaded, "dim_date")).collect()
    some = resolve_keys(plays, artists, dim_table(loaded, "dim_song"), dim_table(loaded, "dim_date"), strict=False)
    assert 0 < some.agg(F.sum("play_count")).first()[0] < 1000
    ok = resolve_keys(plays, dim_table(loaded, "dim_artist"), dim_table(loaded, "dim_song"),
                      dim_table(loaded, "dim_date"))
    assert ok.agg(F.sum("play_count")).first()[0] == 1000
