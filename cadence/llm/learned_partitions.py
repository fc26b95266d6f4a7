"""Approximate nearest neighbours by learned partitions (operator 10).

1. A bounded sample of the vectors gives a graph of nearest neighbours.
2. The graph is cut into balanced partitions: a start by repeated halving along
   principal directions, then rounds in which vectors move to the partition of
   most of their neighbours as far as the partitions' capacity allows.
3. A small classifier (one hidden layer, numpy stochastic gradient descent)
   learns the partition from the vector.
4. Every vector of the table is indexed under its most probable partition.  A
   query goes to its most probable partitions, as many as a part of the sample
   that the classifier did not learn from needs to find ``TARGET`` of its true
   neighbours, and candidates are reranked by the exact cosine.

The sample (``SAMPLE`` vectors) and the model bound what the driver and each
task hold; a partition of any size is searched in parts.  Where the data have no
structure (as in random vectors) most partitions must be searched to keep the
recall.

Vectors that are null, empty or zero, or hold null or non-finite components, take
no part, nor do null ids, and vectors of another length than most of the sample
are searched whole, as a partition of their own.  Ties go to the smaller id; rows
that repeat the query's id are its own.  Equal rows of an id count once.  An id
with several vectors takes one place at most in a query's answer, and a query
with several has one answer: the best score over all of them counts.  Vectors are
scaled by powers of two first, so components of any size take part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.vectors import first_by_hash, search, stack, valid_vectors
from cadence.session import materialise

K = 5
QUERY_MOD = 50
SAMPLE = 4096
PARTITIONS = 16
NEIGHBOURS = 10
HIDDEN = 64
EPOCHS = 12
TARGET = 0.97
SLACK = 1e-9


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others (by cosine) of each unit vector of a sample."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 512):
        close = x[i:i + 512] @ x.T
        close[np.arange(len(close)), np.arange(i, i + len(close))] = -np.inf
        top = np.argpartition(-close, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(close, top, 1), axis=1, kind="stable")
        out[i:i + 512] = np.take_along_axis(top, order, 1)
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12,
                       seed: int = 5) -> np.ndarray:
    """A partition number for each vector, of nearly equal sizes, that cuts few graph edges."""
    label = np.zeros(len(x), np.int64)

    def halve(rows: np.ndarray, first: int, n: int) -> None:
        label[rows] = first
        if n > 1:
            y = x[rows] - x[rows].mean(axis=0)
            direction = np.linalg.svd(y.T @ y)[0][:, 0]
            order = rows[np.argsort(y @ direction, kind="stable")]
            left = n // 2
            cut = len(rows) * left // n
            halve(order[:cut], first, left)
            halve(order[cut:], first + left, n - left)

    halve(np.arange(len(x)), 0, parts)
    capacity = int(np.ceil(1.1 * len(x) / parts))
    rng = np.random.default_rng(seed)
    both = [[] for _ in range(len(x))]
    for i, row in enumerate(graph):
        for j in row:
            both[i].append(int(j))
            both[j].append(i)
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(label[both[i]], minlength=parts)
            best = int(np.where(size < capacity, votes, -1).argmax())
            if votes[best] > votes[label[i]]:
                size[label[i]] -= 1
                size[best] += 1
                label[i] = best
                moved += 1
        if not moved:
            break
    return label


@dataclass(frozen=True)
class Router:
    """The classifier; ``probes`` is how many partitions a query is sent to."""

    dim: int
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def _learn(x: np.ndarray, label: np.ndarray, parts: int, seed: int = 3) -> tuple:
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    w1 = rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN)) * np.sqrt(dim) / 2
    b1, b2 = np.zeros(HIDDEN), np.zeros(parts)
    w2 = rng.normal(0, np.sqrt(2 / HIDDEN), (HIDDEN, parts))
    steps, step = EPOCHS * -(-len(x) // 32), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 32):
            rate = 0.3 * (1 - step / steps)
            step += 1
            rows = order[i:i + 32]
            hidden = np.maximum(x[rows] @ w1 + b1, 0)
            z = hidden @ w2 + b2
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            p /= len(rows)
            back = (p @ w2.T) * (hidden > 0)
            w2 -= rate * hidden.T @ p
            b2 -= rate * p.sum(axis=0)
            w1 -= rate * x[rows].T @ back
            b1 -= rate * back.sum(axis=0)
    return w1, b1, w2, b2


def train_router(sample: np.ndarray, k: int = K, target: float = TARGET,
                 partitions: int = PARTITIONS) -> Router:
    """Partition the sample's neighbour graph, learn it, and fit the number of probes."""
    dim = sample.shape[1]
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    parts = int(np.clip(len(x) // 64, 1, partitions))
    if parts == 1:
        return Router(dim, np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    label = balanced_partition(x, graph, parts)
    held = np.arange(len(x)) % 5 == 4
    router = Router(dim, *_learn(x[~held], label[~held], parts), probes=parts)
    logits = router.logits(x)
    home = logits.argmax(axis=1)
    place = np.argsort(np.argsort(-logits[held], axis=1), axis=1)
    needed = np.take_along_axis(place, home[graph[held][:, :k]], axis=1)
    found = [(needed < n).mean() for n in range(1, parts + 1)]
    probes = next((n for n, share in enumerate(found, 1) if share >= target), parts)
    return Router(dim, router.w1, router.b1, router.w2, router.b2, probes)


def assign(vectors: DataFrame, router: Router, every: bool) -> DataFrame:
    """(g, vec_id, v): each vector under its partition, or (``every``) under all it is sent to."""
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            fits = np.flatnonzero(dims == router.dim)
            at, groups = [np.flatnonzero(dims != router.dim)], []
            groups.append(-dims[at[0]].astype(np.int64))
            if len(fits):
                logits = router.logits(stack(batch.column("v").take(pa.array(fits))))
                n = router.probes if every else 1
                best = np.argsort(-logits, axis=1, kind="stable")[:, :n]
                at.append(np.repeat(fits, best.shape[1]))
                groups.append(best.ravel())
            places = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(groups).astype(np.int64)), batch.column("vec_id").take(places),
                 batch.column("v").take(places)], ["g", "vec_id", "v"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "dim", "v").mapInArrow(run, f"g bigint, vec_id {id_type}, v binary")


def _solve(k: int):
    def solve(ids, v, query_ids, q):
        v_norm, q_norm = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        rough = (q / q_norm[:, None]) @ (v / v_norm[:, None]).T
        names, name = np.unique(ids, return_inverse=True)
        for n, query_id in enumerate(query_ids):
            others = np.flatnonzero(ids != query_id)
            near = rough[n, others]
            best_of = near
            if len(names) < len(ids):
                best_of = np.full(len(names), -np.inf)
                np.maximum.at(best_of, name[others], near)
            if len(best_of) > k:
                near_k = np.partition(best_of, len(best_of) - k)[len(best_of) - k]
                others = others[near >= near_k - SLACK]
            # One row at a time in one order, so equal vectors get equal scores.
            exact = (v[others] * q[n]).sum(axis=1) / (v_norm[others] * q_norm[n])
            best = np.lexsort((ids[others], -exact))
            # The first row of each id.
            best = best[np.sort(np.unique(ids[others][best], return_index=True)[1])][:k]
            yield others[best], exact[best]

    return solve


def scaled(v: np.ndarray) -> np.ndarray | None:
    """A vector times the power of two that brings its largest component near 1.

    That changes no cosine, and squares of tiny or huge components stay in range.
    """
    largest = np.abs(v).max(initial=0.0)
    return np.ldexp(v, -np.frexp(largest)[1]) if largest else None


def nearest(embeddings: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
            vec_col: str = "embedding", sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row for which ``is_query`` (over vec_id) holds."""
    vectors, _ = materialise(
        valid_vectors(embeddings, id_col, vec_col, scaled).distinct(), "ann-vectors")
    picked = [np.frombuffer(r.v, "<f8") for r in first_by_hash(vectors, sample).collect()]
    dims, counts = np.unique([len(v) for v in picked], return_counts=True)
    dim = int(dims[counts.argmax()]) if picked else 1
    router = train_router(np.array([v for v in picked if len(v) == dim]).reshape(-1, dim), k, target)
    data, _ = materialise(assign(vectors, router, False), "ann-index")
    routed, _ = materialise(assign(vectors.where(is_query), router, True)
                            .withColumnsRenamed({"vec_id": "query_id", "v": "q"})
                            .withColumn("copies", F.lit(1).cast("bigint")), "ann-routes")
    return search(data, routed, k, _solve(k), "double", once=True)


def nearest_query(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, F.pmod(F.col("vec_id"), F.lit(QUERY_MOD)) == 0)
