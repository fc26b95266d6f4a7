"""Which labelled rows a classifier may learn from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.text import only


def fold(id_col: str, folds: int, id_of: str | None = None) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_of or id_col).cast("string").cast("binary")), F.lit(folds))


def sample_labels(labels: DataFrame, target: str, folds: int, held_out: int, limit: int,
                  id_col: str = "doc_id") -> DataFrame:
    """(id, label): ``limit`` labelled ids at most, none of the held-out fold.

    Half of the limit goes to each label, so a rare label is not lost; the ids
    are picked by a hash, and of contradicting labels the more frequent counts
    (label 1 at a draw).
    """
    rows = only(labels, id_col, target)
    known = (rows.where(F.col(id_col).isNotNull() & F.col(target).isNotNull()
                        & (fold(id_col, folds) != held_out))
             .groupBy(id_col).agg((F.avg(target) >= 0.5).cast("int").alias("label")))
    picks = [known.where(F.col("label") == label).orderBy(F.xxhash64(id_col), id_col).limit(limit // 2)
             for label in (0, 1)]
    return picks[0].unionByName(picks[1])


def labelled_texts(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, text, label): one row for each sampled id, so the sample bounds the rows too.

    An id with several texts is learned from the smallest one.  The sample has a
    fixed largest size, so it is broadcast and the texts of the other documents
    don't cross the network; copies of a hot id are reduced before the shuffle.
    """
    found = only(docs, id_col, text_col).join(F.broadcast(sample), id_col)
    return found.groupBy(id_col, "label").agg(F.min(text_col).alias(text_col)).select(id_col, text_col, "label")
