from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cadence.functions import (NA_TOKENS, WHITESPACE, minutes_2dp, na_to_null, normalise_name,
                               round_minutes, strict_bigint, weekday_name)


def test_whitespace_set_matches_python():
    assert set(WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}
    assert "\x1c" in WHITESPACE and "　" in WHITESPACE and "​" not in WHITESPACE


@pytest.mark.parametrize("raw,expected", [
    ("\t Blue　\n", "blue"),
    ("\x1cA\x85\xa0", "a"),
    ("  Zz Top ", "zz top"),
    ("1979", "1979"),
    (" Ünïcode ", "ünïcode"),
])
def test_normalise_name_matches_python(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "s string").select(normalise_name("s")).first()[0]
    assert got == expected == raw.lower().strip()


def test_na_tokens_exact_match(spark):
    vals = list(NA_TOKENS) + ["None", "Null", " NA ", "na ", "ok"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r[0] for r in df.select(na_to_null("s")).collect()]
    assert out[: len(NA_TOKENS)] == [None] * len(NA_TOKENS)
    assert out[len(NA_TOKENS):] == ["None", "Null", " NA ", "na ", "ok"]


def test_minutes_half_up_decimal(spark):
    df = spark.createDataFrame([(61500,), (214357,), (30300,), (0,), (29999,), (30000,)], "ms long")
    got = [r[0] for r in df.select(minutes_2dp(F.col("ms"))).collect()]
    assert got == [Decimal("1.03"), Decimal("3.57"), Decimal("0.51"), Decimal("0.00"),
                   Decimal("0.50"), Decimal("0.50")]


def test_two_step_rounding(spark):
    # 214357 ms -> 3.57, 30300 ms -> 0.51; 3.57 + 0.51 = 4.08 -> 4.1
    df = spark.createDataFrame([(214357,), (30300,)], "ms long")
    total = df.agg(round_minutes(F.sum(minutes_2dp(F.col("ms"))))).first()[0]
    assert total == Decimal("4.1")


def test_strict_bigint(spark):
    ok = spark.createDataFrame([("123",), (" 12 ",)], "s string")
    assert [r[0] for r in ok.select(strict_bigint(F.col("s"))).collect()] == [123, 12]
    for bad in ("abc", "123.5"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            spark.createDataFrame([(bad,)], "s string").select(strict_bigint(F.col("s"))).collect()
    d = spark.createDataFrame([(123.9,)], "d double").select(strict_bigint(F.col("d"))).first()[0]
    assert d == 123


def test_weekday_full_name(spark):
    df = spark.createDataFrame([("2026-05-25T22:15:31.907Z",)], "s string")
    assert df.select(weekday_name(F.to_timestamp("s"))).first()[0] == "Monday"
