"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages the documents are
written as Parquet and read again. Texts of any length are read whole. Stages handle nulls, empty texts, repeated rows and extra columns as their operators
state; a row is dropped by (doc_id, text), never by position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe, decontaminate, line_dedup, minhash_dedup, quality
from tradewind.llm.queries import vocabulary_path
from tradewind.llm.shared import drop_rows, save, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a row without an id is judged like any other, one without text goes."""
    judged = quality.quality(docs, table(spark, sf_dir, "labels"))
    return drop_rows(docs, judged.where("not kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with cross-site boilerplate lines removed from their texts; no row is dropped.

    A text from which nothing is removed stays as it is, also null; one of boilerplate only becomes empty. ``n_chars``
    (if there) follows a changed text. A null site counts as one site; repeated rows are changed alike.
    """
    return line_dedup.rewrite(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each near-duplicate component; of several texts under that id, one.

    Rows that repeat id and text stay once. Rows without an id or without words are nobody's copy and stay.
    """
    judged = minhash_dedup.near_duplicates(docs)
    return drop_rows(docs, judged.where("not first")).dropDuplicates(["doc_id", "text"])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and empty texts have none. Repeated rows go or stay together."""
    return drop_rows(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of each document's whole text, and a digest of what decoding gives; null text: no ids."""
    out = bpe.bpe(docs, vocabulary_path())
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("minhash_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("bpe", encoding),
]

#: Trained trees and automata are not SQL; a test holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
