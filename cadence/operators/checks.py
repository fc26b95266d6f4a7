"""Declarative data-quality checks (the model tests, plus DDL guards).

Each check yields a DataFrame of failing rows; the suite reduces every
check to one row ``(check_id, model, column_name, test, failures)`` in a
single Spark job.  Semantics follow the usual warehouse-test conventions:

* ``unique``        one failing row per value that occurs more than once
                    (nulls ignored)
* ``not_null``      one failing row per null
* ``relationships`` one failing row per child row whose (non-null) key is
                    missing from the parent -- a left anti join
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    check_id: str
    model: str
    columns: tuple[str, ...]
    test: str                      # unique | not_null | relationships
    parent: str | None = None      # relationships only
    parent_columns: tuple[str, ...] | None = None

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


# The column tests declared on the staging models.
MODEL_CHECKS = (
    Check("D1", "stg_streams", ("song_stream_id",), "unique"),
    Check("D2", "stg_streams", ("song_stream_id",), "not_null"),
    Check("D3", "stg_streams", ("play_count",), "not_null"),
    Check("D4", "stg_streams", ("total_duration",), "not_null"),
    Check("D5", "stg_artists", ("artist_id",), "unique"),
    Check("D6", "stg_artists", ("artist_id",), "not_null"),
    Check("D7", "stg_artists", ("artist_name",), "not_null"),
    Check("D8", "stg_songs", ("song_id",), "unique"),
    Check("D9", "stg_songs", ("song_id",), "not_null"),
    Check("D10", "stg_songs", ("song_title",), "not_null"),
)

# Table constraints of the star schema, enforced as checks.
STAR_CHECKS = (
    Check("D11a", "dim_artist", ("artist_natural_key",), "unique"),
    Check("D11b", "dim_song", ("song_natural_key",), "unique"),
    Check("D11c", "dim_date", ("year", "month", "hour_of_day", "day_of_week"), "unique"),
    Check("D12a", "fact_song_stream", ("date_id",), "relationships", "dim_date", ("date_id",)),
    Check("D12b", "fact_song_stream", ("song_id",), "relationships", "dim_song", ("song_id",)),
    Check("D12c", "fact_song_stream", ("artist_id",), "relationships", "dim_artist", ("artist_id",)),
)

ALL_CHECKS = MODEL_CHECKS + STAR_CHECKS


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[check.model]
    cols = list(check.columns)
    if check.test == "unique":
        non_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        return (df.where(non_null).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1))
    if check.test == "not_null":
        return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))
    if check.test == "relationships":
        parent = tables[check.parent].select(
            *[F.col(p).alias(c) for p, c in zip(check.parent_columns, cols)])
        non_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        return df.where(non_null).join(parent, cols, "left_anti")
    raise ValueError(f"unknown test {check.test!r}")


def _orphan_count(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose key has no parent, counted per key first.

    The child (the fact) is reduced to (key, rows) with a map-side combine
    before it meets the parent, so the join shuffles distinct keys rather
    than every fact row; summing the per-key counts gives the same number
    as counting failing rows one by one.
    """
    cols = list(check.columns)
    child = tables[check.model]
    non_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    per_key = child.where(non_null).groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
    parent = tables[check.parent].select(
        *[F.col(p).alias(c) for p, c in zip(check.parent_columns, cols)])
    orphans = per_key.join(parent, cols, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))


def _labelled(c: Check, failures) -> DataFrame:
    return F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.model).alias("model"),
                    F.lit(c.column_name).alias("column_name"), F.lit(c.test).alias("test"),
                    failures.cast("bigint").alias("failures"))


def run_checks(tables: dict[str, DataFrame], checks=ALL_CHECKS) -> DataFrame:
    """One row per check with its failure count (W4), in one Spark job.

    All not-null tests on a model share a single scan (one conditional
    count per test); unique and relationship tests each need their own
    shuffle.
    """
    runnable = [c for c in checks
                if c.model in tables and (c.parent is None or c.parent in tables)]
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in runnable:
        if c.test == "not_null":
            by_model.setdefault(c.model, []).append(c)
        elif c.test == "relationships":
            parts.append(_orphan_count(c, tables).select(_labelled(c, F.col("n")).alias("r")))
        else:
            counted = failing_rows(c, tables).agg(F.count(F.lit(1)).alias("n"))
            parts.append(counted.select(_labelled(c, F.col("n")).alias("r")))
    for model, group in by_model.items():
        counts = tables[model].agg(*[
            F.count_if(reduce(lambda a, b: a | b, [F.col(x).isNull() for x in c.columns]))
            .alias(f"n{i}") for i, c in enumerate(group)])
        parts.append(counts.select(F.explode(F.array(*[
            _labelled(c, F.col(f"n{i}")) for i, c in enumerate(group)])).alias("r")))
    return reduce(DataFrame.unionByName, parts).select("r.*")


class ChecksFailed(RuntimeError):
    pass


def assert_checks(results: DataFrame) -> DataFrame:
    """Raise if any check failed.  ``results`` has one row per check."""
    failed = results.where(F.col("failures") > 0).collect()
    if failed:
        detail = ", ".join(f"{r.check_id}({r.model}.{r.column_name} {r.test})={r.failures}"
                           for r in failed)
        raise ChecksFailed(f"data-quality checks failed: {detail}")
    return results
