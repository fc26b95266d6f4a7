"""Line dedup by levelled sorted runs of line hashes (operator 1).

Documents arrive in batches.  A batch's line hashes, each with the number of
documents that hold it, are merge-joined with the sorted runs stored so far:
a hash that no run knows (the anti join) is marked fresh, and the batch is
added as a run of its own, sorted by hash.  ``fanout`` runs of one level are
compacted into a run of the next, so a hash is rewritten once a level.  Over
all runs a hash is fresh exactly once, and its counts add up to the number
of documents that hold it; those that reach ``min_docs`` are the repeated
lines, which lose all their lines in every document.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at both
ends and with A-Z lower-cased; it is stored as a 128-bit hash.  Texts split
at ``\\n``; a null or empty text is one empty line, and empty keys are never
repeated lines.  Every row counts as a document, also when rows or ids are
repeated or the id is null.  A very common line is counted before the
shuffle and joined as one key of an ordinary join, which adaptive execution
splits; texts cross the network once, by document.
"""

from __future__ import annotations

import struct

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm.text import SPACE, as_bytes, bound_batches, only, with_fields
from cadence.session import delete_path, materialise, scratch_path

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 3


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _hash(key: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", xxhash.xxh3_128_digest(key))


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


class LineRuns:
    """The levelled runs under one shared folder.

    A run is a folder ``level=<l>/run=<first>-<last>`` that covers the
    batches first to last.  A run counts once it is completely written, and
    a run inside the range of another is superseded, so a writer that dies
    in a compaction leaves the counts as they were.
    """

    SCHEMA = "h1 bigint, h2 bigint, n_docs bigint, fresh boolean"

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("a level needs two runs at least before it is compacted")
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def _list(self, path: str) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def runs(self) -> list[tuple[int, int, int, str]]:
        """(level, first, last, path) of the runs that count, oldest first."""
        found = []
        for level in self._list(self.root):
            for name in self._list(f"{self.root}/{level}"):
                path = f"{self.root}/{level}/{name}"
                if "_SUCCESS" in self._list(path):
                    first, last = map(int, name.removeprefix("run=").split("-"))
                    found.append((int(level.removeprefix("level=")), first, last, path))
        return sorted((r for r in found
                       if not any(o[0] > r[0] and o[1] <= r[1] and r[2] <= o[2] for o in found)),
                      key=lambda r: r[1])

    def _read(self, runs) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*[r[3] for r in runs])

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> None:
        rows.sortWithinPartitions("h1", "h2").write.mode("overwrite").parquet(
            f"{self.root}/level={level}/run={first:08d}-{last:08d}")

    def add(self, hashes: DataFrame) -> None:
        """Add one batch: rows (h1, h2), one for each document and line in it."""
        runs = self.runs()
        batch = hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))
        if runs:
            known = self._read(runs).where("fresh").select("h1", "h2", F.lit(True).alias("known"))
            batch = batch.join(known.hint("merge"), ["h1", "h2"], "left")
        else:
            batch = batch.withColumn("known", F.lit(None).cast("boolean"))
        number = max((r[2] for r in runs), default=-1) + 1
        self._write(batch.select("h1", "h2", "n_docs", F.col("known").isNull().alias("fresh")),
                    0, number, number)
        self._compact()

    def _compact(self) -> None:
        """Merge every level that holds ``fanout`` runs into one run of the next level."""
        level = 0
        while True:
            runs = self.runs()
            here = [r for r in runs if r[0] == level]
            if len(here) >= self.fanout:
                self._write(self._merged(here), level + 1, here[0][1], here[-1][2])
                for r in here:
                    delete_path(self.spark, r[3])
            elif level >= max((r[0] for r in runs), default=0):
                return
            level += 1

    def _merged(self, runs) -> DataFrame:
        return self._read(runs).groupBy("h1", "h2").agg(
            F.sum("n_docs").alias("n_docs"), F.max("fresh").alias("fresh"))

    def counts(self) -> DataFrame:
        """(h1, h2, n_docs): every line hash with the number of its documents."""
        return self._merged(self.runs()).select("h1", "h2", "n_docs")


def line_hashes(keyed: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k, h1, h2): the distinct line keys of each row of (k, text)."""
    def run(batches):
        for batch in batches:
            ks, h1, h2 = [], [], []
            for k, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                keys = {key for key in map(line_key, text.split(b"\n")) if _long_enough(key, min_chars)}
                for a, b in map(_hash, sorted(keys)):
                    ks.append(k)
                    h1.append(a)
                    h2.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ks, h1, h2)],
                                             ["k", "h1", "h2"])

    return keyed.mapInArrow(run, "k bigint, h1 bigint, h2 bigint")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                fanout: int = FANOUT, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, *keep, n_lines, n_dropped): the documents without repeated lines.

    The text column holds the lines that are left, joined by ``\\n``; n_lines
    counts those before.  Columns that aren't named in ``keep`` are left behind.
    """
    docs = only(docs, id_col, text_col, *keep)
    if min_chars < 1 or min_docs < 1 or batches < 1:
        raise ValueError("min_chars, min_docs and batches are 1 at least")
    spark = docs.sparkSession
    bound_batches(spark)
    # Two documents may share a key: what is kept by key is a set of repeated
    # lines, and a repeated line goes from every document anyway.
    key = F.xxhash64(F.when(F.col(id_col).isNull(), F.col(text_col)).otherwise(
        F.col(id_col).cast("string")))
    keyed = docs.withColumn("_k", key)
    # Stored by batch, so that each batch reads its own folder only.
    lines_path = scratch_path(spark, "line-hashes")
    line_hashes(keyed.select("_k", text_col), min_chars) \
        .withColumn("batch", F.pmod("k", F.lit(batches)).cast("int")) \
        .write.partitionBy("batch").parquet(lines_path)
    lines = spark.read.schema("k bigint, h1 bigint, h2 bigint, batch int").parquet(lines_path)
    runs = LineRuns(spark, scratch_path(spark, "line-runs"), fanout)
    for number in range(batches):
        runs.add(lines.where(F.col("batch") == number).select("h1", "h2"))
    # Stored first, so that both sides of the join are plain shuffles: a line that
    # very many documents share is split by adaptive execution.
    repeated, _ = materialise(runs.counts().where(F.col("n_docs") >= min_docs).select("h1", "h2"),
                              "repeated-lines")
    hits = (lines.select("k", "h1", "h2").join(repeated, ["h1", "h2"])
            .groupBy(F.col("k").alias("_k")).agg(F.collect_set(F.struct("h1", "h2")).alias("hits"))
            .select("_k", F.col("hits.h1").alias("_h1"), F.col("hits.h2").alias("_h2")))
    names = docs.columns
    joined = keyed.join(hits, "_k", "left").select(*names, "_h1", "_h2")
    return joined.mapInArrow(_drop(names.index(text_col), len(names)),
                             with_fields(docs, n_lines="bigint", n_dropped="bigint"))


def _drop(text_at: int, width: int):
    def run(batches):
        for batch in batches:
            kept_texts, n_lines, n_dropped = [], [], []
            for text, h1, h2 in zip(as_bytes(batch.column(text_at)), batch.column(width).to_pylist(),
                                    batch.column(width + 1).to_pylist()):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if h1:
                    repeated = set(zip(h1, h2))
                    lines = [x for x in lines if _hash(line_key(x)) not in repeated]
                n_dropped.append(n_lines[-1] - len(lines))
                kept_texts.append(b"\n".join(lines))
            columns = [batch.column(i) for i in range(width)]
            columns[text_at] = pa.array(kept_texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                [*batch.schema.names[:width], "n_lines", "n_dropped"])
    return run


def line_dedup_digests(docs: DataFrame) -> DataFrame:
    """The registered query: documents' line counts and the digest of what is kept."""
    kept = dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# A repeated line is one whose key stands in ten documents at least.  DuckDB's
# trim takes a set of characters; translate lower-cases A-Z only.
ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.*, r.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
