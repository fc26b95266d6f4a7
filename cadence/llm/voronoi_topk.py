"""Exact top-k search by a Voronoi kNN join (operator 7).

Every component x becomes floor(1024 * x) and scores are integer inner
products.  Pivots, a bounded sample of the data, split the space into Voronoi
cells; data and queries are grouped by their nearest pivot.  A cell is
summarised by its number of vectors and its radius r, the largest distance from
its pivot p.  For a query q the scores in a cell then lie within
q.p - |q| r and q.p + |q| r.  The lower ends, with the cells' numbers of
vectors, bound the k-th best score from below; a query goes only to cells whose
upper end reaches that bound.  Cells are solved locally, in parts of bounded
size, and each query's local winners are merged.

Where distances hardly differ (many dimensions, no structure), few cells can be
ruled out; the result is exact all the same.  Vectors that are null or empty, or
hold null or non-finite components, take no part, nor do null ids.  Vectors of
another length than the query's are no candidates.  Ties go to the smaller id;
rows that repeat the query's id are its own.  Repeated rows of another id
are candidates each, and of repeated rows of a query's id each ranks them (as
in the SQL, so m equal rows of a query fill m places with each candidate); equal
ones are solved once.  Scores must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.vectors import first_by_hash, search, stack, top_rows, valid_vectors
from cadence.session import materialise

SCALE = 1024
K = 10
QUERY_MOD = 100
MAX_PIVOTS = 512
EXACT = 2.0 ** 53


def to_integers(v: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * v)


def inner_products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products q x v: in doubles where these are exact, else in Python's integers."""
    if np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * v.shape[1] < EXACT:
        return (q @ v.T).astype(np.int64)
    whole = lambda x: np.array([[int(c) for c in row] for row in x], object)
    return (whole(q) @ whole(v).T).astype(np.int64)


def _solve(k: int):
    def solve(ids, v, query_ids, q):
        for query_id, scores in zip(query_ids, inner_products(v, q)):
            others = np.flatnonzero(ids != query_id)
            places = others[top_rows(scores[others], ids[others], k)]
            yield places, scores[places]

    return solve


class Cells:
    """Pivots of each vector length, and the cell of a vector."""

    def __init__(self, pivots: list[np.ndarray]):
        self.by_dim: dict[int, np.ndarray] = {}
        for dim in {len(p) for p in pivots}:
            self.by_dim[dim] = np.unique([p for p in pivots if len(p) == dim], axis=0)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pivot number, distance) of vectors of one length; without a pivot one cell
        of unknown radius."""
        pivots = self.by_dim.get(v.shape[1])
        if pivots is None:
            return np.zeros(len(v), np.int64), np.full(len(v), np.inf)
        square = (v ** 2).sum(1)[:, None] - 2 * v @ pivots.T + (pivots ** 2).sum(1)
        cell = square.argmin(axis=1)
        return cell, np.sqrt(((v - pivots[cell]) ** 2).sum(1))


def _by_length(batch, size_col: str, vec_col: str):
    """(places, matrix) of the rows of each vector length of a batch."""
    dims = batch.column(size_col).to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, stack(batch.column(vec_col).take(pa.array(at)))


def group_by_pivot(vectors: DataFrame, cells: Cells) -> DataFrame:
    """(g, vec_id, dim, v, away): every vector with its cell and the distance from its pivot."""
    def run(batches):
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for _, at, v in _by_length(batch, "dim", "v"):
                cell[at], away[at] = cells.nearest(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{d}:{c}" for d, c in zip(batch.column("dim").to_pylist(), cell)]),
                 *(batch.column(c) for c in ("vec_id", "dim", "v")), pa.array(away)],
                ["g", "vec_id", "dim", "v", "away"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "dim", "v").mapInArrow(
        run, f"g string, vec_id {id_type}, dim int, v binary, away double")


def route(queries: DataFrame, cells: Cells, summaries: dict[str, tuple[int, float]], k: int) -> DataFrame:
    """(g, query_id, q, copies): one row for each cell that may hold one of a query's k best.

    ``queries`` has (vec_id, dim, v, copies, own), where ``own`` counts the rows of
    the query's id, which are in the cells' numbers but are no candidates.
    """
    def run(batches):
        for batch in batches:
            at_all, groups = [], []
            for dim, at, q in _by_length(batch, "dim", "v"):
                pivots = cells.by_dim.get(dim, np.zeros((1, dim)))
                known = [(c, *summaries[f"{dim}:{c}"]) for c in range(len(pivots)) if f"{dim}:{c}" in summaries]
                numbers = np.array([c for c, _, _ in known])
                counts = np.array([n for _, n, _ in known])
                radius = np.array([r for _, _, r in known])
                middle = q @ pivots[numbers].T
                reach = np.linalg.norm(q, axis=1)[:, None] * radius
                # Rounding of doubles must never rule out a cell.
                slack = 1 + 1e-9 * (np.abs(middle) + np.where(np.isfinite(reach), reach, 0))
                reach = np.where(np.isfinite(reach), reach, np.inf)
                low, high = middle - reach - slack, middle + reach + slack
                order = np.argsort(-low, axis=1)
                # All rows of the query's id may be among the first.
                own = batch.column("own").to_numpy()[at]
                enough = np.cumsum(counts[order], axis=1) >= k + own[:, None]
                first = np.where(enough.any(axis=1), enough.argmax(axis=1), low.shape[1] - 1)
                bound = np.where(enough.any(axis=1), low[np.arange(len(q)), order[np.arange(len(q)), first]], -np.inf)
                rows, picked = np.nonzero(high >= bound[:, None])
                at_all += at[rows].tolist()
                groups += [f"{dim}:{numbers[c]}" for c in picked]
            at_all = pa.array(at_all, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.string()), batch.column("vec_id").take(at_all),
                 batch.column("v").take(at_all), batch.column("copies").take(at_all)],
                ["g", "query_id", "q", "copies"])

    id_type = queries.schema["vec_id"].dataType.simpleString()
    return queries.select("vec_id", "dim", "v", "copies", "own").mapInArrow(
        run, f"g string, query_id {id_type}, q binary, copies bigint")


def exact_topk(embeddings: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
               vec_col: str = "embedding", max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row for which ``is_query`` (over vec_id) holds."""
    vectors, _ = materialise(valid_vectors(embeddings, id_col, vec_col, to_integers), "topk-vectors")
    n = vectors.count()
    pivots = int(np.clip(np.sqrt(n) / 4, 1, max_pivots))
    cells = Cells([np.frombuffer(r.v, "<f8") for r in first_by_hash(vectors, pivots).collect()])
    grouped, _ = materialise(group_by_pivot(vectors, cells), "topk-cells")
    # One row for each pivot (and each vector length without one).
    summaries = {r.g: (r.n, r.radius) for r in grouped.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()}
    asked = grouped.where(is_query).groupBy("vec_id", "dim", "v").agg(F.count(F.lit(1)).alias("copies"))
    own = asked.groupBy("vec_id", "dim").agg(F.sum("copies").alias("own"))
    routed, _ = materialise(route(asked.join(own, ["vec_id", "dim"]), cells, summaries, k), "topk-routes")
    return search(grouped.select("g", "vec_id", "v"), routed, k, _solve(k), "bigint")


def topk_query(embeddings: DataFrame) -> DataFrame:
    return exact_topk(embeddings, F.pmod(F.col("vec_id"), F.lit(QUERY_MOD)) == 0)


ORACLE_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
