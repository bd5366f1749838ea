"""Queries of the training-data operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    bpe,
    chat,
    decontaminate,
    divergence,
    license_scan,
    line_dedup,
    lm_score,
    merkle,
    minhash_dedup,
    quality,
    secret_scan,
    substring_dedup,
    token_counts,
)
from tradewind.llm.shared import table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    """Where the public tokenizer files are on this machine."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices in every document; null and empty texts have none. A row per row of ``documents``."""
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("blocks")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on ten or more sites removed from every document; a null source is one site. A row per row of ``documents``."""
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every document; null and empty texts have none. A row per row of ``documents``."""
    start, inner = token_counts.byte_vocabulary(vocabulary_path())
    return token_counts.token_counts(table(spark, sf_dir, "documents"), start, inner)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document; a null text is its end alone. A row per row of ``documents``."""
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at 85 percent; a document without words is alone. A row per row of ``documents``."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("text_key", "first")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages; null and empty texts have none. A row per row of ``documents``."""
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).drop("removed")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; null and empty texts have none. A row per row of ``documents``."""
    out = secret_scan.secret_scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_linked")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests; a null text has no ids. A row per row of ``documents``."""
    out = bpe.bpe(table(spark, sf_dir, "documents"), vocabulary_path())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and verdict of every document; one without words fails. A row per row of ``documents``."""
    out = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents: a row per document, item and passage; null and empty texts have none."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted in windows and read back. A row per conversation."""
    said = "</s>[INST] ok [/INST]"
    hostile = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(hostile)
    return chat.read_back(turns, *token_counts.byte_vocabulary(vocabulary_path()))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, folded from a tampered copy of every seventh. A row per row of ``documents``."""
    out = merkle.manifest(table(spark, sf_dir, "documents"), merkle.off_by_one())
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source of each language against the others and the language. Null text, language or source: empty."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_line_dedup,
        op3_token_counts,
        op4_lm_scoring,
        op5_minhash_dedup,
        op6_substring_dedup,
        op7_secret_scan,
        op8_bpe,
        op9_quality_rules,
        op10_decontamination,
        op11_chat_format,
        op12_merkle_manifest,
        op13_source_divergence,
    )
}

SQL: dict[str, str] = {
    "op1_license_scan": license_scan.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op5_minhash_dedup": minhash_dedup.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_source_divergence": divergence.SQL,
}
