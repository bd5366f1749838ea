"""Cleaning and projection: null markers, time zones, partition columns, row hashes, generated columns, the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that mean "no value".
NULL_MARKERS = ("", "NULL", "None", "null", "none", "N/A", "n/a")
#: The order in which a timestamp for partition columns is looked for.
TIME_COLUMNS = ("updated_at", "occurred_at", "created_at", "ordered_at")


def clean_strings(df: DataFrame) -> DataFrame:
    """Trims every string column; null markers become null. One projection for all columns."""

    def clean(c: str) -> Column:
        t = F.trim(F.col(c))
        return F.when(~t.isin(*NULL_MARKERS), t).alias(c)

    return df.select(*[clean(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])


def to_utc(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """All timestamps of a source that writes local time of ``zone``, in UTC."""
    return df.select(
        *[
            F.to_utc_timestamp(F.col(f.name).cast("timestamp"), zone).alias(f.name) if isinstance(
                f.dataType,
                T.TimestampType | T.TimestampNTZType,
            ) else F.col(f.name)
            for f in df.schema.fields
        ],
    )


def add_partition_cols(df: DataFrame, ts_col: str | None = None) -> DataFrame:
    """Text columns year, month, day of ``ts_col``, or of the first of ``TIME_COLUMNS`` that there is."""
    ts = ts_col or next((c for c in TIME_COLUMNS if c in df.columns), None)
    if ts is None:
        raise ValueError("no timestamp column to partition by")
    return df.withColumns({name: F.date_format(F.col(ts), pattern) for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))})


def row_hash(cols: list[str]) -> Column:
    """SHA-256 over the columns in name order, as text joined by a bar; null counts as the empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(cols)]), 256)


#: Generated columns by kind: name and expression.
GENERATED = {
    "inventory": ("quantity_available", "quantity_on_hand - quantity_reserved"),
    "session": ("duration_seconds", "cast(unix_timestamp(ended_at) - unix_timestamp(started_at) as bigint)"),
    "item": ("line_total", "quantity * unit_price"),
    "order": ("total", "subtotal + tax + shipping"),
}


def with_generated(df: DataFrame, kind: str) -> DataFrame:
    name, expression = GENERATED[kind]
    return df.withColumn(name, F.expr(expression))


def date_dim(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day: yyyymmdd key, names, ISO week, quarter, fiscal year from April (named after its start)."""
    d = F.col("full_date")
    fiscal = F.add_months(d, -3)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date"))
    big = lambda x: x.cast("bigint")
    return days.select(
        big(F.date_format(d, "yyyyMMdd")).alias("date_key"), d.alias("full_date"), big(F.dayofweek(d) - 1).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), big(F.dayofmonth(d)).alias("day_of_month"), big(F.dayofyear(d)).alias("day_of_year"), big(F.weekofyear(d)).alias("week_of_year"),
        big(F.month(d)).alias("month_num"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short"), big(F.quarter(d)).alias("quarter"), big(F.year(d)).alias("year"), F.date_format(d, "yyyy-MM").alias("year_month"), big(F.year(fiscal)).alias("fiscal_year"), big(F.quarter(fiscal)).alias("fiscal_quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"), F.lit(False).alias("is_holiday"), F.lit(None).cast("string").alias("holiday_name"),
    )
