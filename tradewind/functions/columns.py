"""Column helpers: exact rounding, guarded ratios, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order states that count as no sale at all, and those that the reports leave out as well.
CANCELLED, NOT_SOLD = ("cancelled",), ("cancelled", "refunded")


def rounded(x: Column, digits: int = 0) -> Column:
    """Half-up on the double, the same in every engine: floor(x * 10^d + 0.5) / 10^d."""
    scale = float(10**digits)
    return F.floor(x.cast("double") * scale + 0.5).cast("double") / scale


def money(cents: Column) -> Column:
    """Cents as currency units with two digits."""
    return rounded(cents.cast("double") / 100.0, 2)


def ratio(num: Column, den: Column, digits: int, factor: float = 100.0) -> Column:
    """factor * num / den, null where den is 0."""
    return rounded(num.cast("double") * factor / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def big(x: Column) -> Column:
    return x.cast("bigint")


def n_distinct(c: str | Column, when: Column | None = None) -> Column:
    """Exact distinct count, optionally of rows that meet a condition only."""
    value = F.col(c) if isinstance(c, str) else c
    return big(F.count_distinct(value if when is None else F.when(when, value)))


def n_where(when: Column) -> Column:
    return big(F.count(F.when(when, 1)))


def month(d: Column) -> Column:
    return F.trunc(d, "month")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Month boundaries crossed, which differs from Spark's count of complete months."""
    return big((F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier)))


def sold(fo: DataFrame, without: tuple[str, ...] = CANCELLED) -> DataFrame:
    """Rows of known status that is not in ``without``."""
    return fo.where(~F.col("order_status").isin(*without))


def latest(df: DataFrame, col: str) -> DataFrame:
    """One row: the day of the newest ``col``, as ``as_of``."""
    return df.agg(F.max(F.col(col)).cast("date").alias("as_of"))


def with_as_of(df: DataFrame, as_of: str | None, col: str) -> DataFrame:
    """``df`` with a column ``as_of``: the given day, or the day of the newest ``col`` (a one-row broadcast)."""
    if as_of is not None:
        return df.withColumn("as_of", F.lit(as_of).cast("date"))
    return df.crossJoin(F.broadcast(latest(df, col)))


def with_first(df: DataFrame, key: str, at: Column) -> DataFrame:
    """``df``, which is read twice, with ``first``: the key's smallest ``at``. A value per key is joined back, so a key
    with very many rows is split; a null key is a key."""
    first = df.groupBy(F.col(key).alias("__key")).agg(F.min(at).alias("first"))
    return df.join(first, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
