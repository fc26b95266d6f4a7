import json
import os

import pytest
from pyspark.sql import functions as F

from cadence.operators.clean import clean_plays, to_processed
from cadence.schemas import STAGED
from cadence.sources import csv_files, raw_json


def _write_pages(tmp_path, pages, name="p.json"):
    d = tmp_path / "landing"
    d.mkdir(exist_ok=True)
    with open(d / name, "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    return str(d)


def item(name="Blue", tid="s1", dur=214357, artists=None, played_at="2026-05-25T22:15:31.907Z"):
    track = {}
    if name is not None:
        track["name"] = name
    if tid is not None:
        track["id"] = tid
    if dur is not None:
        track["duration_ms"] = dur
    if artists is not None:
        track["artists"] = artists
    out = {"track": track}
    if played_at is not None:
        out["played_at"] = played_at
    return out


def test_flatten_defaults(spark, tmp_path):
    pages = [{"items": [
        item(artists=[{"id": "a1", "name": "Yung Kai"}, {"id": "a2", "name": "Other"}]),
        item(artists=[]),
        item(name=None, dur=None, played_at=None, artists=[{"id": "a1"}]),
    ]}, {"items": []}]
    path = _write_pages(tmp_path, pages)
    rows = [tuple(r) for r in raw_json.read_staged_from_json(spark, path).collect()]
    assert rows == [
        ("Blue", "Yung Kai", "2026-05-25T22:15:31.907Z", 214357, "a1", "s1"),
        ("Blue", "N/A", "2026-05-25T22:15:31.907Z", 214357, None, "s1"),
        ("N/A", "N/A", "N/A", 0, "a1", "s1"),
    ]
    # "N/A" defaults never survive cleaning
    cleaned = clean_plays(raw_json.read_staged_from_json(spark, path)).collect()
    assert [(r.artist_name, r.artist_natural_key) for r in cleaned] == [("yung kai", "a1")]


def test_multiline_document(spark, tmp_path):
    d = tmp_path / "ml"
    d.mkdir()
    (d / "page.json").write_text(json.dumps({"items": [item(artists=[{"id": "a", "name": "n"}])]},
                                            indent=2))
    assert raw_json.read_staged_from_json(spark, str(d), multiline=True).count() == 1


def test_malformed_json_fails(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "x.json").write_text('{"items": [ {"played_at": "x", "track": \n')
    with pytest.raises(Exception):
        raw_json.read_staged_from_json(spark, str(d)).collect()


def test_pages_round_trip(spark, tmp_path):
    from cadence.sources.feed import event_plays
    plays = event_plays(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "pages")
    pages = raw_json.to_raw_pages(plays, page_size=7)
    raw_json.write_raw_pages(pages, path)
    back = spark.read.schema(raw_json.RAW_PAGE).json(path)
    assert back.select(F.max(F.size("items"))).first()[0] <= 7
    assert raw_json.read_staged_from_json(spark, path).count() == plays.count()


def test_recent_window_and_cap(spark):
    rows = [("t", "x", f"2026-05-25T{h:02d}:00:00.500Z", "1", "a1", "s1") for h in range(24)]
    rows.append(("t", "x", "2026-05-24T12:00:00.000Z", "1", "a1", "s1"))
    rows.append(("t", "x", "2026-05-24T12:00:00.900Z", "1", "a1", "s1"))
    df = spark.createDataFrame(rows, STAGED)
    # as_of floored to the second: 2026-05-25T12:00:00 -> cutoff 2026-05-24T12:00:00 (exclusive)
    w = raw_json.recent_window(df, "2026-05-25 12:00:00.700", days=1)
    # ... up to as_of itself: hours 0-12 of the day, and the evening before.
    assert w.count() == 14
    cap = raw_json.latest_plays(clean_plays(w), n=5)
    assert [r.hour_of_day for r in cap.collect()] == [12, 11, 10, 9, 8]
    per = raw_json.latest_plays(clean_plays(w), n=2, per="artist_natural_key")
    assert per.count() == 2


def test_csv_text_round_trips(spark, tmp_path):
    rows = [('say "hi", ok', " pad ", "2026-05-25T22:15:31.907Z", "1", "a,1", "s\n1"),
            ("", None, "2026-05-25T22:15:31.907Z", "2", "a", "s")]
    df = spark.createDataFrame(rows, STAGED)
    path = str(tmp_path / "staging")
    csv_files.save_staging(df, path, fmt="csv")
    back = csv_files.read_staging(spark, path, fmt="csv")
    got = sorted(map(tuple, back.collect()), key=lambda t: t[3])
    assert got[0] == rows[0]
    # An empty cell reads back as missing, as with the original CSV reader.
    assert got[1] == (None,) + rows[1][1:]


def test_missing_processed_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_files.read_processed(spark, str(tmp_path / "nope"), fmt="csv").collect()


def test_processed_parquet_round_trip(spark, tmp_path):
    df = to_processed(clean_plays(spark.createDataFrame(
        [("Blue", "Yung Kai", "2026-05-25T22:15:31.907Z", "214357", "a", "s")], STAGED)))
    path = str(tmp_path / "processed")
    csv_files.save_processed(df, path)
    assert [tuple(r) for r in csv_files.read_processed(spark, path).collect()] == \
        [("blue", "yung kai", 214357, "a", "s", 2026, 5, 22, "Monday")]
    assert not os.path.exists(os.path.join(path, "index"))
