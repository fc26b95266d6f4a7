"""Vectors in tables, and exact search of queries in groups of them, in blocks.

Shared by the two search operators.  Vectors travel as their doubles in
binary.  A group of data and the queries that need it are solved in units of
bounded size: large groups are cut into parts by a hash of the row's number, so
that rows of one id spread too, many queries of one group into parts as well,
and a unit holds one part of each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.text import only

DATA_ROWS = 4096
QUERY_ROWS = 4096


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """The doubles of each vector; None if null or empty, or with null or non-finite parts."""
    out = []
    for x in column:
        values = x.values if x.is_valid else None
        if values is None or not len(values) or values.null_count:
            out.append(None)
            continue
        v = values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(v if np.isfinite(v).all() else None)
    return out


def stack(column) -> np.ndarray:
    """A matrix of the binary vectors of a column (one length)."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str,
                  change: Callable[[np.ndarray], np.ndarray | None] = lambda v: v) -> DataFrame:
    """(vec_id, dim, v): the vectors that take part, after ``change`` (None: left out)."""
    def run(batches):
        for batch in batches:
            at, dims, found = [], [], []
            for i, v in enumerate(rows_of(batch.column(1))):
                v = None if v is None else change(v)
                if v is not None:
                    at.append(i)
                    dims.append(len(v))
                    found.append(v.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(dims, pa.int32()),
                 pa.array(found, pa.binary())], ["vec_id", "dim", "v"])

    rows = only(df, id_col, vec_col).where(F.col(f"`{id_col}`").isNotNull())
    return rows.mapInArrow(run, f"vec_id {rows.schema[id_col].dataType.simpleString()}, dim int, v binary")


def first_by_hash(vectors: DataFrame, n: int) -> DataFrame:
    """A repeatable sample of ``n`` rows."""
    return vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n)


def top_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def search(data: DataFrame, routed: DataFrame, k: int, solve, score_type: str,
           once: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of its groups.

    ``data`` has (g, vec_id, v), ``routed`` one row (g, query_id, q, copies) for
    each group that a query needs.  ``solve(ids, v, query_id, q)`` gives, for one
    query and one part of a group, places and scores of its k best rows there.
    Each of the copies of a query ranks a row; with ``once``, an id takes one
    place of a query_id, with its best score.
    Both inputs are stored tables, whose rows have the same numbers at every reading.
    """
    sizes = data.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / DATA_ROWS).alias("d_parts")) \
        .join(routed.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("q_parts")), "g")
    steps = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    numbered = lambda df: df.withColumn("row", F.monotonically_increasing_id())
    left = (numbered(data).join(sizes, "g").withColumn("dp", part("d_parts")).withColumn("qp", steps("q_parts"))
            .select("g", "dp", "qp", "vec_id", "v"))
    right = (numbered(routed).join(sizes, "g").withColumn("qp", part("q_parts"))
             .withColumn("dp", steps("d_parts")).select("g", "dp", "qp", "query_id", "q", "copies"))
    id_type = data.schema["vec_id"].dataType.simpleString()

    def unit(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found_q, found_v, found_s, found_c = [], [], [], []
        if rows.num_rows and queries.num_rows:
            ids, v = rows.column("vec_id").to_numpy(), stack(rows.column("v"))
            q_ids, q = queries.column("query_id").to_numpy(), stack(queries.column("q"))
            copies = queries.column("copies").to_pylist()
            for i in range(0, len(q), 256):
                for query_id, n, (places, scores) in zip(q_ids[i:i + 256], copies[i:i + 256],
                                                         solve(ids, v, q_ids[i:i + 256], q[i:i + 256])):
                    found_q += [query_id] * len(places)
                    found_c += [n] * len(places)
                    found_v.append(ids[places])
                    found_s.append(scores)
        cat = lambda x: np.concatenate(x) if x else []
        return pa.table({"query_id": pa.array(found_q, rows.schema.field("vec_id").type),
                         "vec_id": pa.array(cat(found_v), rows.schema.field("vec_id").type),
                         "score": pa.array(cat(found_s), pa.int64() if score_type == "bigint" else pa.float64()),
                         "copies": pa.array(found_c, pa.int64())})

    best = left.groupBy("g", "dp", "qp").cogroup(right.groupBy("g", "dp", "qp")).applyInArrow(
        unit, f"query_id {id_type}, vec_id {id_type}, score {score_type}, copies bigint")
    if once:
        best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    else:
        # More than k copies of a row can't all be among the k best.
        best = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(k)))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
