"""Staging / processed files.

Parquet is the default format; CSV is kept for parity with the
original file layers and round-trips text exactly (quotes, commas,
padding, newlines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cadence.schemas import PROCESSED, STAGED

# Writer defaults that would alter text: Spark trims unquoted whitespace on
# write and escapes quotes with a backslash.  RFC 4180 quoting instead.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ_OPTIONS = {
    "header": "true",
    "escape": '"',
    "mode": "FAILFAST",
}


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with a headered CSV directory (no index column)."""
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Read a headered CSV with a fixed schema; a missing path raises.

    ``multiline=False`` makes files splittable, for text known to hold no line ends.
    """
    reader = spark.read.schema(schema).options(**CSV_READ_OPTIONS).option("multiLine", multiline)
    return reader.csv(path)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_csv(df, path)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, multiline: bool) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema, multiline)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unknown format {fmt!r}")


def save_staging(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(df, path, fmt)


def read_staging(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType = STAGED, multiline: bool = True) -> DataFrame:
    return _read(spark, path, schema, fmt, multiline)


def save_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    _write(df, path, fmt)


def read_processed(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: T.StructType = PROCESSED, multiline: bool = True) -> DataFrame:
    return _read(spark, path, schema, fmt, multiline)
