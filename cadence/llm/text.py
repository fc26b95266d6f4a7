"""Helpers shared by the operators: Arrow batches, byte buffers, hashes.

Texts travel to Python as Arrow batches and are handled there as bytes.
Work on many short texts is done on a joined buffer of about a megabyte, so
the temporary arrays stay small whatever the batch holds; one longer text
forms a buffer of its own and is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BUFFER_BYTES = 1 << 20
BATCH_ROWS = 500

# White space of the contracts: [\x20\x09-\x0D], as bytes.
SPACE = b" \t\n\x0b\x0c\r"


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Hold at most ``rows`` texts in one Arrow batch.

    Spark also ends a batch at ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB
    by default), but the texts of such a batch take several times that as Python
    objects and arrays, and short ones wait for each other.  The setting is read
    when the job runs, so it stays set in the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) not in range(1, rows + 1):
        spark.conf.set(key, str(rows))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; clashing extra columns (any case) are left behind."""
    picked = []
    for name in names:
        hits = [c for c in df.columns if c == name] or \
               [c for c in df.columns if c.lower() == name.lower()]
        if len(hits) != 1:
            raise ValueError(f"column {name!r} is missing or not unique in {df.columns}")
        picked.append(hits[0])
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[f"`{c}`" for c in picked]).toDF(*names)
    # Names that differ only in case can't be told apart by name: go by place.
    places = [df.columns.index(c) for c in picked]
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]) \
             .select(*[f"c{i}" for i in places]).toDF(*names)


def with_fields(df: DataFrame, **types: str) -> T.StructType:
    """The schema of ``df`` with further columns, given by their SQL types."""
    more = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in types.items()))
    return T.StructType([*df.schema.fields, *more.fields])


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def buffers(texts: list[bytes], limit: int = BUFFER_BYTES):
    """(first, last, buffer, starts, ends): runs of texts joined by spaces.

    ``buffer`` is a uint8 array that ends in a space; text i of the run is
    ``buffer[starts[i]:ends[i]]``, and a space follows it.
    """
    first, held = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or (held and held + len(texts[i]) > limit):
            if i > first:
                run = texts[first:i]
                sizes = np.fromiter(map(len, run), np.int64, len(run))
                ends = np.cumsum(sizes + 1) - 1
                data = np.frombuffer(b" ".join(run) + b" ", np.uint8)
                yield first, i, data, ends - sizes, ends
            first, held = i, 0
        if i < len(texts):
            held += len(texts[i]) + 1


_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _byte_values() -> np.ndarray:
    """A fixed odd 64-bit value for each byte (splitmix64 of its number)."""
    out = []
    for b in range(256):
        z = (b + 1) * _ODD & _MASK
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & _MASK
        z = (z ^ z >> 27) * 0x94D049BB133111EB & _MASK
        out.append((z ^ z >> 31) | 1)
    return np.array(out, np.uint64)


_VALUES = _byte_values()
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n at least, kept between calls."""
    have = _powers[kind]
    base = _BASE if kind == "up" else _INVERSE
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    if len(have) <= 4 * BUFFER_BYTES:
        _powers[kind] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class SpanHashes:
    """64-bit hashes of any spans of one buffer, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        sums = np.empty(self.n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_VALUES[data] * _power("up", self.n), out=sums[1:])
        self.sums = sums
        self.down = _power("down", self.n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes from each place on."""
        if self.n < size:
            return np.empty(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[:self.n + 1 - size])


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a buffer that ends in a space."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _IS_SPACE[data]])))
    return edges[0::2], edges[1::2]


