import pytest

from cadence.operators.clean import EmptyBatchError, clean_plays, to_processed
from tests.conftest import staged_df

GOLDEN_STAGED = ("blue", "yung kai", "2026-05-25T22:15:31.907Z", "214357",
                 "6zO1dZ40fTZ5hY9NnnRJSk", "3be9ACTxtcL6Zm4vJRUiPG")
GOLDEN_PROCESSED = ("blue", "yung kai", 214357, "6zO1dZ40fTZ5hY9NnnRJSk",
                    "3be9ACTxtcL6Zm4vJRUiPG", 2026, 5, 22, "Monday")


def test_golden_pair(spark):
    out = to_processed(clean_plays(staged_df(spark, [GOLDEN_STAGED]))).collect()
    assert [tuple(r) for r in out] == [GOLDEN_PROCESSED]


def _one(spark, title="Blue", artist="Yung Kai", played="2026-05-25T22:15:31.907Z", dur="214357"):
    return staged_df(spark, [(title, artist, played, dur, "a1", "s1")])


@pytest.mark.parametrize("title,expected", [
    ("\t Blue　\n", "blue"), ("None", "none"), ("Null", "null"), (" NA ", "na"),
    ("\x1cBlue\x85", "blue"), ("1979", "1979"), ("BLUE ", "blue"),
])
def test_title_kept_and_normalised(spark, title, expected):
    out = to_processed(clean_plays(_one(spark, title=title))).collect()
    assert [r.song_title for r in out] == [expected]


@pytest.mark.parametrize("field", ["title", "artist", "played", "dur"])
@pytest.mark.parametrize("value", [None, "N/A", "NA", "null", "NaN", "n/a", ""])
def test_missing_or_na_token_drops_row(spark, field, value):
    out = clean_plays(_one(spark, **{field: value})).collect()
    assert out == []


def test_bad_duration_fails_batch(spark):
    for bad in ("abc", "123.5"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            clean_plays(_one(spark, dur=bad)).collect()


def test_bad_timestamp_fails_batch(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|DATETIME|cannot be cast"):
        clean_plays(_one(spark, played="not-a-date")).collect()


def test_empty_batch_raises_before_any_work(spark):
    with pytest.raises(EmptyBatchError):
        clean_plays(staged_df(spark, []), check_empty=True)


def test_all_rows_dropped_is_not_an_error(spark):
    assert clean_plays(_one(spark, title="N/A"), check_empty=True).collect() == []


def test_padded_duration_parses(spark):
    out = clean_plays(_one(spark, dur=" 12 ")).collect()
    assert out[0].song_duration_ms == 12


def test_calendar_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        from cadence.session import ensure_conf
        ensure_conf(spark)
        out = clean_plays(_one(spark)).first()
        assert (out.year, out.month, out.hour_of_day, out.day_of_week) == (2026, 5, 22, "Monday")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
