"""Small documents with the awkward cases every operator must handle."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use themselves, some in other case.
CLASHES = ["k", "ids", "piece", "score", "label", "n_lines", "rep", "key", "batch", "TEXT", "_k", "length"]


def documents(spark, texts, first_id=0):
    rows = [(first_id + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    """Nulls, empty and blank texts, repeated rows, a null id, one very long text."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "one two three four five six"), (2, None), (3, ""), (4, " \n\t\n"), (5, long_text),
            (6, "one two three four five six"), (6, "one two three four five six"), (None, "lone text"),
            (None, None), (7, "é\n\nÉ ß \x1c x")]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


def with_clashes(docs):
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def rows(df, *columns):
    """Rows as sorted tuples (nulls first)."""
    columns = columns or df.columns
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    return sorted(found, key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))


def oracle(sql, sf_dir=SF, tables=("documents", "labels", "conversations", "embeddings"), **frames):
    con = duckdb.connect()
    for t in tables:
        if t not in frames:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name, frame in frames.items():
        con.register(name, frame)
    return con.execute(sql).df()


def same(df, expected):
    """A Spark result equals a pandas frame, whatever the order of rows and columns."""
    got = df.toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    names = sorted(got.columns)
    left = sorted(map(tuple, got[names].astype(object).values.tolist()), key=str)
    right = sorted(map(tuple, expected[names].astype(object).values.tolist()), key=str)
    if left != right:
        pytest.fail(f"{len(left)} and {len(right)} rows; first difference "
                    f"{next(((a, b) for a, b in zip(left, right) if a != b), None)}")
