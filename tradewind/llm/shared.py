"""Shared helpers of the training-data operators: work tables and input hygiene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.store import discard, save, work_dir

__all__ = ["discard", "drop_rows", "fold", "save", "table", "texts", "work_dir"]


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """Only what an operator needs, under fixed names, so that extra or clashing columns do no harm."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"), *more)


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows whose (doc_id, text_key) is in ``gone``; absent ids compare as equal."""
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(gone["__gone_id"]) & (
        F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == gone["__gone_key"]
    )
    return docs.join(gone, same, "left_anti")


def fold(id_col: Column, folds: int) -> Column:
    """CRC32 of the id as text, modulo ``folds``; an absent id counts as the empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
