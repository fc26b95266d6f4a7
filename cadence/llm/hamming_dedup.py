"""MinHash near-dedup by a multi-index Hamming join (operator 6).

A document's set holds its distinct shingles of ``SHINGLE`` words (A-Z
lower-cased, words ``[^\\x20\\x09-\\x0D]+``); with fewer words the whole
sequence is its one shingle, and without words the set is empty and linked
with nothing.  Documents are linked if 100 * intersection >= percent * union
(85 in operator 6).

1. Equal sets form one class, named by its smallest id; all further work is on
   classes, so groups of copies cost one row each.
2. A class has a signature of ``SYMBOLS`` b-bit minhashes (b = 16).  The
   signature is split into ``CHUNKS`` chunks.  By the pigeonhole principle two
   signatures that differ in ``DISTANCE`` symbols at most agree in some chunk
   up to the errors allowed for it, floor(DISTANCE / CHUNKS) in the first
   chunks and one less in the rest.  The allowed errors of a chunk are
   enumerated: one key for each choice of the symbols that may differ, made of
   the others.  Classes that share a key are candidates, so every pair within
   the distance shares one.  ``fit`` chooses the distance, and the reach of the
   next step, for the percentage.
3. Classes that share a key and whose signatures are within ``REACH`` are near.
   A bucket (a key's classes) whose classes are all near its smallest one is
   connected by that star; other buckets are compared whole, in blocks of
   bounded size.  Each gives edges that connect its near classes, never all
   pairs, and the connected parts are clusters: no near pair lies in two.
4. In each cluster, in blocks again, near pairs are confirmed on the full sets,
   starting from found links, so that only pairs which no link connects yet are
   compared.  The links found connect exactly what all links would.

A pair at a similarity of 0.85 differs in 6 of 40 symbols on average; it
shares no key with a chance of 6e-6, and lies beyond REACH = 18 with a chance
of 1.2e-6.  At 0.80 the distance is 16 and the reach 21, with chances of 5e-6
and 1.1e-6.  Hot keys (a passage that many documents share) are
counted before the shuffle and joined in joins that adaptive execution splits,
and their buckets are cut into blocks, as are large clusters; a task holds two
blocks at most.

Null and empty texts, and texts of white space, have empty sets.  Rows with a
null id take no part and come back with a null component and kept = true.
Rows that repeat an id are one document; if their texts differ, the smallest
set (as bytes) is the one that is confirmed.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.components import connected_components
from cadence.llm.text import SpanHashes, as_bytes, bound_batches, buffers, lower_ascii, mix, only, word_spans
from cadence.session import materialise

SHINGLE = 5
PERCENT = 85
SYMBOLS = 40
CHUNKS = 8
DISTANCE = 13
REACH = 18
BLOCK = 1024
# Largest chances that a pair at the threshold shares no key, or lies beyond the reach.
NO_KEY = 1e-5
TOO_FAR = 2e-6


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_FACTORS = _odd_numbers(SYMBOLS, 11)
_PLACES = _odd_numbers(SHINGLE, 12)


# -- sets and signatures ------------------------------------------------------------

def shingle_sets(texts: list[bytes]):
    """The sorted distinct 64-bit shingle hashes of each text."""
    for first, last, data, starts, ends in buffers(texts):
        data = lower_ascii(data)
        begin, end = word_spans(data)
        words = SpanHashes(data).spans(begin, end) if len(begin) else np.empty(0, np.uint64)
        cuts = np.searchsorted(begin, np.append(starts, len(data)))
        rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for i in range(SHINGLE):
            rolled += words[i:i + len(rolled)] * _PLACES[i]
        rolled = mix(rolled)
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= SHINGLE:
                yield np.unique(rolled[a:b - SHINGLE + 1])
            elif b > a:
                few = np.array([b - a], np.uint64)
                for i in range(a, b):
                    few = few * _FACTORS[1] + words[i:i + 1] * _PLACES[i - a]
                yield mix(few)
            else:
                yield np.empty(0, np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """The b-bit minhashes of a set that isn't empty."""
    least = np.empty(SYMBOLS, np.uint64)
    for i in range(0, SYMBOLS, 8):
        x = found[:, None] * _FACTORS[i:i + 8]
        x ^= x >> np.uint64(31)
        x *= _FACTORS[i:i + 8]
        least[i:i + 8] = x.min(axis=0)
    return (mix(least) >> np.uint64(48)).astype("<u2")


def _set_name(found: np.ndarray) -> tuple[int, int]:
    """A 128-bit name of a set, whatever its order."""
    a = int(mix(found).sum(dtype=np.uint64)) ^ len(found)
    b = int(mix(found ^ _FACTORS[0]).sum(dtype=np.uint64))
    return tuple(np.array([a, b], np.uint64).view(np.int64).tolist())


def chunk_plan(symbols: int = SYMBOLS, chunks: int = CHUNKS, distance: int = DISTANCE) -> list[tuple[int, ...]]:
    """The symbols that make up each key: all but the allowed errors of a chunk.

    With at most distance = e * chunks + r differing symbols, one of the first
    r + 1 chunks has at most e of them, or one of the others at most e - 1.
    """
    errors, rest = divmod(distance, chunks)
    edges = np.linspace(0, symbols, chunks + 1).astype(int)
    keys = []
    for c in range(chunks):
        inside = range(edges[c], edges[c + 1])
        allowed = errors if c <= rest else errors - 1
        if allowed < 0:
            continue
        keys += [tuple(x for x in inside if x not in wrong) for wrong in combinations(inside, allowed)]
    return keys


def _more_than(allowed: int, symbols: int, percent: int) -> float:
    """The chance that more than ``allowed`` of ``symbols`` differ at a similarity of ``percent``."""
    p = 1 - percent / 100
    return sum(comb(symbols, i) * p ** i * (1 - p) ** (symbols - i) for i in range(allowed + 1, symbols + 1))


@lru_cache
def fit(percent: int) -> tuple[int, int]:
    """(distance, reach): the smallest that lose a pair at the threshold with NO_KEY and TOO_FAR at most."""
    def no_key(distance: int) -> float:
        errors, rest = divmod(distance, CHUNKS)
        chance = 1.0
        for c, size in enumerate(np.diff(np.linspace(0, SYMBOLS, CHUNKS + 1).astype(int)).tolist()):
            chance *= _more_than(errors if c <= rest else errors - 1, size, percent)
        return chance

    return (next(d for d in range(SYMBOLS + 1) if no_key(d) <= NO_KEY),
            next(r for r in range(SYMBOLS + 1) if _more_than(r, SYMBOLS, percent) <= TOO_FAR))


_KEYS = chunk_plan()


def keys_of(signatures: np.ndarray, plan: list[tuple[int, ...]] = _KEYS) -> np.ndarray:
    """The 64-bit keys of signatures (a row each), a column for every key of the plan."""
    wide = signatures.astype(np.uint64)
    out = np.empty((len(wide), len(plan)), np.uint64)
    for k, members in enumerate(plan):
        x = np.full(len(wide), k + 1, np.uint64)
        for m in members:
            x = x * np.uint64(0x9E3779B97F4A7C15) + wide[:, m] + np.uint64(1)
        out[:, k] = mix(x)
    return out.view(np.int64)


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, s1, s2, sig): the name and signature of every document's set."""
    def run(batches):
        for batch in batches:
            n, s1, s2, sigs = [], [], [], []
            for found in shingle_sets(as_bytes(batch.column(1))):
                n.append(len(found))
                a, b = _set_name(found) if len(found) else (None, None)
                s1.append(a)
                s2.append(b)
                sigs.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(sigs, pa.binary())],
                [id_col, "n_shingles", "s1", "s2", "sig"])

    rows = only(docs, id_col, text_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_shingles bigint, s1 bigint, s2 bigint, sig binary")


# -- candidates -----------------------------------------------------------------------

def bucket_members(classes: DataFrame, plan: list[tuple[int, ...]] = _KEYS) -> DataFrame:
    """(key, rep, leader, size): the classes of every key that two classes share at least."""
    def run(batches):
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, SYMBOLS)
            keys = keys_of(sigs, plan)
            at = np.repeat(np.arange(len(sigs)), keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel(), pa.int64()), batch.column(0).take(pa.array(at))], ["key", "rep"])

    rep_type = classes.schema["rep"].dataType.simpleString()
    keyed = classes.select("rep", "sig").mapInArrow(run, f"key bigint, rep {rep_type}")
    buckets = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("leader"))
               .where(F.col("size") > 1))
    # Stored first, so that both sides of the join are plain shuffles, which can be split.
    buckets, _ = materialise(buckets, "near-keys")
    return keyed.join(buckets, "key")


def _near(pairs: DataFrame, classes: DataFrame, reach: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in ``reach`` symbols at most."""
    sig = classes.select("rep", "sig")
    both = (pairs.join(sig.withColumnsRenamed({"rep": "a", "sig": "sig_a"}), "a")
            .join(sig.withColumnsRenamed({"rep": "b", "sig": "sig_b"}), "b")
            .select("a", "b", "sig_a", "sig_b"))

    def run(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, SYMBOLS)
                           for i in (2, 3))
            near = (left != right).sum(axis=1) <= reach
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near))

    return both.mapInArrow(run, both.select("a", "b").schema)


def _spanning(n: int, side: np.ndarray | None, neighbours) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of n nodes: edges (i, j).

    ``neighbours(i, some)`` returns which of the nodes ``some`` are linked with i; it is
    asked for nodes that aren't reached yet.  With ``side``, only for the other side's.
    """
    seen = np.zeros(n, bool)
    left, right = [], []
    for start in range(n):
        if seen[start]:
            continue
        seen[start] = True
        todo = [start]
        while todo:
            i = todo.pop()
            some = np.flatnonzero(~seen if side is None else ~seen & (side != side[i]))
            if not len(some):
                continue
            found = neighbours(i, some)
            seen[found] = True
            todo.extend(found.tolist())
            left.append(np.full(len(found), i))
            right.append(found)
    empty = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _deal(rows: DataFrame, group: str) -> DataFrame:
    """Cut groups into ``parts`` parts and let every two of them meet.

    Rows (group, parts, rep, ...) become rows with (p, q): part p of a group goes
    to (p, q) or (q, p) for every part q, smaller number first.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    return dealt.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")}) \
        .drop("parts", "other")


def _side(table: pa.Table) -> np.ndarray | None:
    """Which part each row is of, if two parts meet."""
    if table.column("p")[0].as_py() == table.column("q")[0].as_py():
        return None
    return table.column("part").to_numpy()


def _signatures(table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)


def near_edges(members: DataFrame, classes: DataFrame, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that connect all classes which share a key and are near.

    A bucket whose classes are all near its smallest is connected by its star.
    The others are compared whole, in blocks, and give a spanning forest.
    """
    stars = members.where(F.col("rep") != F.col("leader")).select(
        F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    near, _ = materialise(_near(stars, classes, reach), "near-stars")
    apart = (members.where((F.col("size") > 2) & (F.col("rep") != F.col("leader")))
             .join(near.withColumnsRenamed({"a": "leader", "b": "rep"}), ["leader", "rep"], "left_anti")
             .select("key").distinct())
    rows = (members.join(apart, "key").join(classes.select("rep", "sig"), "rep")
            .select("key", F.ceil(F.col("size") / block).alias("parts"), "rep", "sig"))

    def compare(table: pa.Table) -> pa.Table:
        sigs = _signatures(table)

        def neighbours(i, some):
            return some[(sigs[some] != sigs[i]).sum(axis=1) <= reach]

        left, right = _spanning(len(sigs), _side(table), neighbours)
        rep = table.column("rep")
        return pa.table({"x": rep.take(pa.array(left)), "y": rep.take(pa.array(right))})

    rep_type = classes.schema["rep"].dataType.simpleString()
    found = _deal(rows, "key").groupBy("key", "p", "q").applyInArrow(compare, f"x {rep_type}, y {rep_type}")
    return near.unionByName(found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()


# -- confirmation on the full sets ----------------------------------------------------------

def _sets_of(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, found): the full sets of the named representatives, as sorted 64-bit values."""
    rows = only(docs, id_col, text_col).join(reps.select(F.col("rep").alias(id_col)), id_col, "left_semi")

    def run(batches):
        for batch in batches:
            found = [s.astype("<u8").tobytes() for s in shingle_sets(as_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "found"])

    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"rep {id_type}, found binary").groupBy("rep").agg(
        F.min("found").alias("found"))


def linked_edges(clusters: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
                 percent: int = PERCENT, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that connect all linked classes of each cluster (node, component).

    Every near pair of a cluster is confirmed on its full sets, unless links that
    were found before connect it already.
    """
    rows = clusters.withColumnsRenamed({"node": "rep", "component": "cluster"}).join(
        classes.select("rep", "sig", "n_shingles"), "rep")
    sizes = rows.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n_shingles") / (block * 1024))).alias("parts"))
    sets = _sets_of(docs, rows.select("rep"), id_col, text_col)
    rows = rows.join(sets, "rep").join(sizes, "cluster").select("cluster", "parts", "rep", "sig", "found")

    def confirm(table: pa.Table) -> pa.Table:
        sigs = _signatures(table)
        sets = [np.frombuffer(v.as_buffer(), "<u8") for c in table.column("found").chunks for v in c]
        sizes = np.array([len(s) for s in sets])
        numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        marked = np.zeros(numbers.max() + 1, bool)

        def neighbours(i, some):
            some = some[(sigs[some] != sigs[i]).sum(axis=1) <= reach]
            some = some[np.minimum(sizes[some], sizes[i]) * 100 >= percent * np.maximum(sizes[some], sizes[i])]
            if not len(some):
                return some
            own = numbers[cuts[i]:cuts[i + 1]]
            marked[own] = True
            shared = np.array([np.count_nonzero(marked[numbers[cuts[j]:cuts[j + 1]]]) for j in some])
            marked[own] = False
            return some[100 * shared >= percent * (sizes[some] + sizes[i] - shared)]

        left, right = _spanning(len(sets), _side(table), neighbours)
        rep = table.column("rep")
        return pa.table({"a": rep.take(pa.array(left)), "b": rep.take(pa.array(right))})

    rep_type = classes.schema["rep"].dataType.simpleString()
    return _deal(rows, "cluster").groupBy("cluster", "p", "q").applyInArrow(confirm, f"a {rep_type}, b {rep_type}")


# -- the operator ----------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, class_id, component_id, kept) for every row of ``docs``."""
    bound_batches(docs.sparkSession)
    distance, reach = fit(percent)
    described, _ = materialise(describe(docs, id_col, text_col), "near-described")
    named = described.where(F.col("s1").isNotNull() & F.col(id_col).isNotNull())
    classes, _ = materialise(named.groupBy("s1", "s2").agg(
        F.min(id_col).alias("rep"), F.min("n_shingles").alias("n_shingles"), F.min("sig").alias("sig")),
        "near-classes")
    members, _ = materialise(bucket_members(classes, chunk_plan(distance=distance)), "near-buckets")
    near, _ = materialise(near_edges(members, classes, reach, block), "near-edges")
    clusters, _ = materialise(connected_components(near, "a", "b"), "near-clusters")
    links, _ = materialise(linked_edges(clusters, classes, docs, id_col, text_col, percent, reach, block),
                           "near-links")
    components, _ = materialise(connected_components(links, "a", "b"), "near-components")

    membership, _ = materialise(
        classes.select("s1", "s2", "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select("s1", "s2", "rep", F.coalesce("component", "rep").alias("component_id")), "near-membership")
    joined = described.drop("sig").join(membership, ["s1", "s2"], "left")
    component = F.coalesce("component_id", F.col(id_col))
    return joined.select(
        id_col, "n_shingles", F.coalesce("rep", F.col(id_col)).alias("class_id"),
        component.alias("component_id"),
        F.coalesce(F.col(id_col) == component, F.lit(True)).alias("kept"))
