"""Bad records do not stop a stream: they become rejects, good plays load."""

import json

import pytest
from pyspark.sql import functions as F

from cadence.operators.clean import clean_plays, examine_plays, good_plays, refused_rows
from cadence.operators.star import compact, fact_song_stream, fold, load_star
from cadence.sources.warehouse import Warehouse
from cadence.streaming.incremental import run_incremental
from tests.conftest import staged_df


def item(song="s1", played_at="2026-05-25T22:00:00Z", artist="a1", **track):
    return {"played_at": played_at, "track": {
        "name": "n", "id": song, "duration_ms": 1000, "artists": [{"id": artist, "name": "x"}], **track}}


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))


def reasons(wh):
    return sorted((r.reason, r.batch_id) for r in wh.all_rejects().collect())


def test_bad_records_are_stored_and_the_stream_goes_on(spark, tmp_path):
    landing, ckpt = tmp_path / "landing", str(tmp_path / "ckpt")
    land(landing, "1.json", {"items": [item(), item(song=None), item(played_at="not-a-date"),
                                       item(duration_ms="12.5"), item(artist=None)]},
         '{"items": [', "no json", '{"items": "text"}', {"items": []}, {})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run_incremental(spark, str(landing), wh, ckpt)
    assert fact_song_stream(wh).agg(F.sum("play_count")).first()[0] == 1
    first = reasons(wh)
    assert [r for r, _ in first] == ["malformed page"] * 3 + [
        "no artist id", "no song id", "unreadable played_at", "unreadable song_duration_ms"]
    bad = {r.record for r in wh.all_rejects().where("reason = 'malformed page'").collect()}
    assert bad == {'{"items": [', "no json", '{"items": "text"}'}
    where = wh.all_rejects().where("record is not null").select("source").distinct().collect()
    assert len(where) == 1 and where[0].source.endswith("1.json")
    times = wh.all_rejects().where("reason = 'unreadable played_at'").first()
    assert json.loads(times.record)["played_at"] == "not-a-date" and times.song_natural_key == "s1"

    # The next micro-batch runs, and what it refuses adds to the rest.
    land(landing, "2.json", {"items": [item("s2"), item(song=None)]})
    run_incremental(spark, str(landing), wh, ckpt)
    assert fact_song_stream(wh).agg(F.sum("play_count")).first()[0] == 2
    assert len(reasons(wh)) == len(first) + 1 and len({b for _, b in reasons(wh)}) == 2
    # Folding keeps the rejects and whom they belong to.
    before = reasons(wh)
    compact(wh)
    assert reasons(wh) == before and not wh.state().rejects
    assert wh.read_rejects(before[0][1]).count() in (1, len(first))


def test_a_stream_may_still_fail_on_bad_records(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.json", {"items": [item()]}, "no json")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception, match="malformed page"):
        run_incremental(spark, str(landing), wh, str(tmp_path / "ckpt"), fail_on_reject=True)
    assert not wh.state().facts


def test_a_malformed_file_of_one_document_is_one_reject(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "good.json").write_text(json.dumps({"items": [item()]}, indent=1))
    (landing / "bad.json").write_text('{\n"items": [\n')
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run_incremental(spark, str(landing), wh, str(tmp_path / "ckpt"), multiline=True)
    assert fact_song_stream(wh).agg(F.sum("play_count")).first()[0] == 1
    assert [r for r, _ in reasons(wh)] == ["malformed page"]


def test_examined_plays_are_the_cleaned_ones(spark):
    rows = [(" Blue\t", "X", "2026-05-25T22:15:31.907Z", " 12 ", "a1", "s1"), ("N/A", "x", "bad", "bad", "a", "s"),
            ("t", "x", "NA", "1", "a", "s"), ("t", "x", None, "1", "a", "s"), ("t", "x", "2026-05-25", None, "a", None)]
    staged = staged_df(spark, rows)
    got, want = good_plays(examine_plays(staged)), clean_plays(staged)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    bad = staged_df(spark, [("t", "x", "2026-05-25", "1e3", "a", "s"), ("t", "x", "soon", "x", None, None)])
    assert sorted(r.reason for r in refused_rows(examine_plays(bad)).collect()) == [
        "unreadable played_at", "unreadable song_duration_ms"]


def test_rejects_of_many_folds_are_merged(spark, warehouse, monkeypatch):
    from cadence.operators import star
    monkeypatch.setattr(star, "MAX_FOLDED", 1)
    for number in range(3):
        plays = clean_plays(staged_df(spark, [("t", "x", "2026-05-25T22:00:00Z", "1", "a1", "s1"),
                                              (f"t{number}", "x", "2026-05-25T22:00:00Z", "1", "a1", None)]))
        load_star(warehouse, plays, f"b{number}", fail_on_reject=False)
        assert fold(warehouse, keep_pending=0)
    assert len(warehouse.state().refused) == 1
    assert [warehouse.read_rejects(f"b{n}").first().song_title for n in range(3)] == ["t0", "t1", "t2"]
    with pytest.raises(KeyError):
        warehouse.read_rejects("b9")
