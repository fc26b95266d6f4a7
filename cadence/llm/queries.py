"""The registered queries of the operators, and their SQL where it can be given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import (byte_bpe, chat_format, chunk_collocations, complement_pack, hamming_dedup, learned_partitions,
                         license_rules, line_runs, rank_bpe, spelling_variants, subword_quality,
                         toxic_grammar, voronoi_topk)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_dedup_digests(_table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digests(_table(spark, sf_dir, "conversations"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_quality.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ).select("doc_id", "held_out", "score", "predicted")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complement_pack.pack_documents(_table(spark, sf_dir, "documents"),
                                          tokenizer("byte_bpe_50k.json"), pattern())


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(_table(spark, sf_dir, "documents"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept", "class_id")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_topk.topk_query(_table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"),
                               tokenizer("byte_bpe_multi_50k.tiktoken"), pattern())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_grammar.toxicity_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ).select("doc_id", "held_out", "score", "predicted")


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.nearest_query(_table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), pattern())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_chat_format": op2_chat_format,
        "op3_quality": op3_quality,
        "op4_packing": op4_packing,
        "op5_license_scan": op5_license_scan,
        "op6_minhash_dedup": op6_minhash_dedup,
        "op7_exact_topk": op7_exact_topk,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_toxicity": op9_toxicity,
        "op10_learned_partitions": op10_learned_partitions,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_collocations": op12_collocations,
        "op13_rank_bpe": op13_rank_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_runs.ORACLE_SQL,
        "op2_chat_format": chat_format.ORACLE_SQL,
        "op7_exact_topk": voronoi_topk.ORACLE_SQL,
        "op11_spelling_variants": spelling_variants.ORACLE_SQL,
        "op12_collocations": chunk_collocations.ORACLE_SQL,
    }
