"""The corpus pipeline: what each stage keeps goes on to the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
stored as Parquet and read again as the next one's docs.  All stages but the
last return the columns of documents.

1. quality   documents that the quality classifier rejects go
2. toxicity  documents that the toxicity grammar marks go
3. lines     lines found in ten documents or more go from every document
4. near      of each group of near duplicates (sets of five words with a
             similarity of 0.8 or more) the one with the smallest id stays
5. packing   what is left is packed into sequences of 2048 tokens

Rows whose doc_id is null are scored and cleaned like others, and stay in the
near stage, where only rows with an id can be linked; fully repeated documents
(equal id and text) stay once.  A null text counts as empty.  Columns other
than those of documents are left behind.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import complement_pack, hamming_dedup, line_runs, queries, subword_quality, toxic_grammar
from cadence.llm.text import only
from cadence.session import delete_path, materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = COLUMNS[2:]
NEAR_PERCENT = 80


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = subword_quality.quality_scores(docs, _labels(spark, sf_dir), keep=REST)
    return scored.where(F.col("predicted") == 1).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxic_grammar.toxicity_scores(docs, _labels(spark, sf_dir), keep=REST)
    return scored.where(F.col("predicted") == 0).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(docs, keep=REST)
    return kept.select(*COLUMNS[:-1], F.length("text").cast("bigint").alias("n_chars"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = only(docs, *COLUMNS)
    kept = hamming_dedup.near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select("doc_id")
    with_id = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return with_id.unionByName(docs.where(F.col("doc_id").isNull()).dropDuplicates(["text"]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return complement_pack.pack_documents(docs, queries.tokenizer("byte_bpe_50k.json"), queries.pattern())


STAGES = [("quality", quality), ("toxicity", toxicity), ("lines", lines), ("near", near),
          ("packing", packing)]

# Trained scores and tokenisation are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, new_path = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path:
            delete_path(spark, path)
        path = new_path
    return docs
