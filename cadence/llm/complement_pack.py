"""Best-fit packing by exact-complement hashing (operator 4).

Documents become token ids, each followed by a terminator.  Longer ones than
``capacity`` are cut into pieces of that size, the first being the shorter
one.  The pieces are packed into as few sequences as the method finds:

1. The pieces' lengths are counted.  There are ``capacity`` lengths at most,
   whatever the number of documents, so the counts fit on the driver.
2. The counts are an index by length.  Single lengths, then pairs, then
   triples that fill the capacity exactly are looked up by their complement
   and consumed as often as the counts of all their lengths allow.
3. What is left goes, longest first, into the open sequence with the
   smallest gap that takes it (best fit); equal sequences are kept as one
   pattern with a count.
4. The plan, a few thousand patterns with their counts, gives every
   (length, rank within the length) its sequence and offset.  Ranks come from
   counts by length and salt, so a length that holds a third of all pieces is
   spread over as many tasks as there are salts.

A null text counts as empty and takes the terminator alone.  Equal documents
are packed one by one; no two pieces share a place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.byte_bpe import encode_with_added, encoding
from cadence.llm.text import as_bytes, bound_batches, only, with_fields
from cadence.session import materialise

CAPACITY = 2048
TERMINATOR = 0
Pattern = tuple[tuple[int, ...], int]


def piece_bounds(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n_ids`` ids."""
    head = n_ids % capacity or capacity
    return [(0, min(head, n_ids))] + [(s, capacity) for s in range(head, n_ids, capacity)]


def token_pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY,
                 terminator: int = TERMINATOR, keep_ids: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document."""
    bound_batches(docs.sparkSession)
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            at, numbers, starts, lengths, sums, parts = [], [], [], [], [], []
            for i, raw in enumerate(as_bytes(batch.column(1))):
                ids = np.append(encode_with_added(enc, path, raw.decode()), np.uint32(terminator)).astype("<u4")
                for number, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    at.append(i)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    part = ids[start:start + length]
                    sums.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        parts.append(part.astype(np.int64))
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()),
                       *(pa.array(c, pa.int64()) for c in (starts, lengths, sums))]
            if keep_ids:
                columns.append(pa.array(parts, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = only(docs, id_col, text_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, piece int, start bigint, length bigint, "
                                "ids_crc32 bigint" + ", ids array<bigint>" * keep_ids)


def exact_patterns(left: Counter, capacity: int) -> list[Pattern]:
    """Consume the singles, pairs and triples that fill ``capacity``; ``left`` keeps the rest."""
    patterns = []

    def take(*lengths: int) -> None:
        n = min(left[x] // k for x, k in Counter(lengths).items())
        if n:
            patterns.append((lengths, n))
            for x in lengths:
                left[x] -= n

    take(capacity)
    for a in range(capacity - 1, (capacity - 1) // 2, -1):
        take(a, capacity - a)
    for a in sorted((x for x in left if left[x]), reverse=True):
        for b in range(min(a, capacity - a - 1), (capacity - a - 1) // 2, -1):
            if not left[a]:
                break
            if left[b] and left[capacity - a - b]:
                take(a, b, capacity - a - b)
    return patterns


def best_fit_patterns(left: Counter, capacity: int) -> list[Pattern]:
    """Best fit of the remaining lengths, longest first; equal sequences stay together."""
    gaps: list[int] = []                    # sorted gaps of the open patterns
    open_at: dict[int, list[list]] = {}     # gap -> [[lengths, count], ...]
    done: list[Pattern] = []

    def put(lengths: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(lengths)
        if gap == 0:
            done.append((lengths, n))
            return
        if gap not in open_at:
            open_at[gap] = []
            insort(gaps, gap)
        open_at[gap].append([lengths, n])

    for length in sorted((x for x in left if left[x]), reverse=True):
        n = left[length]
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # New sequences, each filled with this length as best fit would.
                per = capacity // length
                if n >= per:
                    put((length,) * per, n // per)
                    n %= per
                else:
                    put((length,) * n, 1)
                    n = 0
                continue
            gap = gaps[at]
            entry = open_at[gap][-1]
            used = min(n, entry[1])
            entry[1] -= used
            if not entry[1]:
                open_at[gap].pop()
                if not open_at[gap]:
                    del open_at[gap]
                    gaps.pop(at)
            put((*entry[0], length), used)
            n -= used
        left[length] = 0
    return done + [(tuple(lengths), n) for entries in open_at.values() for lengths, n in entries]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns (lengths, how often) that hold every counted length once."""
    left = Counter({int(k): int(v) for k, v in counts.items() if v})
    if any(not 0 < x <= capacity for x in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    return exact_patterns(left, capacity) + best_fit_patterns(left, capacity)


def places(patterns: list[Pattern], counts: dict[int, int]):
    """The plan by slot: slots number the pieces by (length, rank).

    Returns (first slot of each length, interval starts, their first sequence
    ids, their offsets); in an interval sequence ids go up with the slots.
    """
    base, total = {}, 0
    for length in sorted(counts):
        base[length] = total
        total += counts[length]
    following = dict(base)
    intervals, sequence = [], 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            intervals.append((following[length], sequence, offset))
            following[length] += n
            offset += length
        sequence += n
    intervals.sort()
    return (base, *(np.array([x[i] for x in intervals], np.int64) for i in range(3)))


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """Give every piece its sequence_id and offset.

    ``pieces`` is read three times: pass stored rows (see ``pack_documents``).
    """
    spark = pieces.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    names = pieces.columns
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    base, starts, sequences, offsets = places(plan(counts, capacity), counts)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_salt")
                             .rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(id_col, "piece"))
    ranked = (salted.withColumn("_rank", rank).join(first, ["length", "_salt"])
              .select(*names, (F.col("_before") + F.col("_rank") - 1).alias("_rank")))
    firsts = np.zeros(capacity + 1, np.int64)
    for length, slot in base.items():
        firsts[length] = slot
    length_at = names.index("length")

    def run(batches):
        for batch in batches:
            length = batch.column(length_at).to_numpy(zero_copy_only=False)
            slot = firsts[length] + batch.column(len(names)).to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, slot, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))),
                 pa.array(sequences[at] + slot - starts[at], pa.int64()),
                 pa.array(offsets[at], pa.int64())], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, with_fields(pieces, sequence_id="bigint", offset="bigint"))


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY,
                   terminator: int = TERMINATOR, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack documents; the pieces are stored once in between."""
    pieces, _ = materialise(token_pieces(docs, path, pattern, capacity, terminator, keep_ids), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, each ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
