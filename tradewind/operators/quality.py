"""Data quality: rules as data, checks as rows, a report, and a gate.

Checks are rows (table_name, check_name, column_name, severity, status, bad, total). A table's checks come from one
pass over its rows; only counts reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import big

SCHEMA = "table_name string, check_name string, column_name string, severity string, status string, bad bigint, total bigint"


@dataclass(frozen=True)
class Rules:
    required: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    key: str | None = None
    null_limit: float = 0.01
    fresh: str | None = None
    fresh_hours: float = 3.0


#: What each table must hold.
RULES = {
    "orders": Rules(
        (
            "order_id",
            "order_number",
            "customer_id",
            "order_status",
            "total_cents",
            "order_created_at",
            "item_id",
            "product_id",
            "quantity",
            "unit_price_cents",
        ),
        ("order_id", "customer_id", "order_status", "total_cents", "order_created_at", "product_id"),
        {"total_cents": (0, 10_000_000), "quantity": (1, 10_000), "unit_price_cents": (0, 100_000_000)},
        "item_id",
        0.01,
        "order_created_at",
    ),
    "customers": Rules(
        ("customer_id", "email", "first_name", "last_name", "country_code", "created_at"),
        ("customer_id", "email"),
        {"loyalty_points": (0, 10_000_000)},
        "customer_id",
        0.02,
        "updated_at",
    ),
    "products": Rules(
        ("product_id", "sku", "product_name", "category_id", "base_price_cents", "created_at"),
        ("product_id", "sku", "product_name"),
        {"base_price_cents": (0, 100_000_000), "avg_rating": (0, 5)},
        "product_id",
        0.02,
        "updated_at",
    ),
    "events": Rules(
        ("event_id", "event_type", "occurred_at"),
        ("event_id", "event_type", "occurred_at"),
        {},
        "event_id",
        0.05,
        "occurred_at",
    ),
}


def check_schema(df: DataFrame, table: str, cols: tuple[str, ...]) -> DataFrame:
    """One row per missing column, critical; one passed row when all are there."""
    missing = [c for c in cols if c not in df.columns]
    rows = [(table, "schema", c, "CRITICAL", "FAILED", 1, len(cols)) for c in missing] or [
        (table, "schema", None, "INFO", "PASSED", 0, len(cols))
    ]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def _rows(counts: DataFrame, table: str, found: list[tuple[str, str, str]], judge) -> DataFrame:
    """Unpivots one row of counts: (check, column, name of the count)."""
    each = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(col).alias("column_name"),
            big(F.col(name)).alias("bad"),
        ) for check, col, name in found
    ]
    df = counts.select(big(F.col("__n")).alias("total"), F.explode(F.array(*each)).alias("x")).select("total", "x.*")
    severity, status = judge(F.col("bad"), F.col("total"))
    return df.select(
        F.lit(table).alias("table_name"),
        "check_name",
        "column_name",
        severity.alias("severity"),
        status.alias("status"),
        "bad",
        "total",
    )


def check_nulls(df: DataFrame, table: str, cols: tuple[str, ...], limit: float) -> DataFrame:
    """Null rate per column: critical over the limit, else a warning over 0; an empty table is a warning."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(cols)])
    over = lambda bad, n: bad.cast("double") / F.nullif(n.cast("double"), F.lit(0.0)) > limit
    judge = lambda bad, n: (
        F.when(n == 0, "WARNING").when(bad == 0, "INFO").when(over(bad, n), "CRITICAL").otherwise("WARNING"),
        F.when((n == 0) | (bad > 0), "FAILED").otherwise("PASSED"),
    )
    return _rows(counts, table, [("null_rate", c, f"n{i}") for i, c in enumerate(cols)], judge)


def check_ranges(df: DataFrame, table: str, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values out of bounds per column, critical; nulls pass."""
    def outside(c: str):
        lo, hi = bounds[c]
        return (F.col(c) < lo if lo is not None else F.lit(False)) | (F.col(c) > hi if hi is not None else F.lit(False))

    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.when(outside(c), 1)).alias(f"n{i}") for i, c in enumerate(bounds)])
    judge = lambda bad, n: (F.when(bad > 0, "CRITICAL").otherwise("INFO"), F.when(bad > 0, "FAILED").otherwise("PASSED"))
    return _rows(counts, table, [("range", c, f"n{i}") for i, c in enumerate(bounds)], judge)


def check_duplicates(df: DataFrame, table: str, key: str) -> DataFrame:
    """Surplus rows of the key (null counts as one value), critical; skipped without the column."""
    if key not in df.columns:
        return df.sparkSession.createDataFrame([(table, "duplicates", key, "INFO", "SKIPPED", 0, 0)], SCHEMA)
    counts = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("__n"), F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("n0"))
    )
    judge = lambda bad, n: (F.when(bad > 0, "CRITICAL").otherwise("INFO"), F.when(bad > 0, "FAILED").otherwise("PASSED"))
    return _rows(counts, table, [("duplicates", key, "n0")], judge)


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once, null keys among them. Counts are made first and joined back, so that a
    key with very many rows is split like any skewed join rather than gathered."""
    often = df.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__k")
    return df.join(often, df[key].eqNullSafe(often["__k"]), "left_semi")


def check_freshness(df: DataFrame, table: str, ts: str, hours: float, as_of: str | None = None) -> DataFrame:
    """A warning when the newest value is older than ``hours`` before ``as_of`` (now without one), or there is none."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    age = F.unix_timestamp(now) - F.unix_timestamp(F.max(ts).cast("timestamp"))
    counts = df.agg(F.count(F.lit(1)).alias("__n"), F.when(F.coalesce(age > hours * 3600, F.lit(True)), 1).otherwise(0).alias("n0"))
    judge = lambda bad, n: (F.when(bad > 0, "WARNING").otherwise("INFO"), F.when(bad > 0, "FAILED").otherwise("PASSED"))
    return _rows(counts, table, [("freshness", ts, "n0")], judge)


def check_fk(df: DataFrame, table: str, fk: str, ref: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key the other table lacks, a warning; a null key is an orphan."""
    known = ref.select(F.col(key).alias("__k")).distinct().withColumn("__known", F.lit(1))
    per = df.groupBy(F.col(fk).alias("__k")).agg(F.count(F.lit(1)).alias("k")).join(known, "__k", "left")
    counts = per.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("__n"),
        F.coalesce(F.sum(F.when(F.col("__known").isNull(), F.col("k"))), F.lit(0)).alias("n0"),
    )
    judge = lambda bad, n: (F.when(bad > 0, "WARNING").otherwise("INFO"), F.when(bad > 0, "FAILED").otherwise("PASSED"))
    return _rows(counts, table, [("referential", fk, "n0")], judge)


def run_checks(
    df: DataFrame,
    table: str,
    rules: Rules,
    as_of: str | None = None,
    refs: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """All checks of a table; a broken schema stops after its own check."""
    checks = [check_schema(df, table, rules.required)]
    if any(c not in df.columns for c in rules.required):
        return checks[0]
    have = [c for c in rules.not_null if c in df.columns]
    checks += [check_nulls(df, table, tuple(have), rules.null_limit)] if have else []
    bounds = {c: b for c, b in rules.ranges.items() if c in df.columns}
    checks += [check_ranges(df, table, bounds)] if bounds else []
    checks += [check_duplicates(df, table, rules.key)] if rules.key else []
    checks += [check_freshness(df, table, rules.fresh, rules.fresh_hours, as_of)] if rules.fresh in df.columns else []
    checks += [check_fk(df, table, fk, ref, key) for fk, (ref, key) in (refs or {}).items()]
    return reduce(DataFrame.unionByName, checks)


def summarize(checks: DataFrame) -> DataFrame:
    """Per table: FAILED with a critical failure, DEGRADED with a warning, else PASSED; and counts."""
    failed = lambda s: big(F.count(F.when((F.col("status") == "FAILED") & (F.col("severity") == s), 1)))
    by = checks.groupBy("table_name").agg(
        big(F.count(F.lit(1))).alias("checks"),
        big(F.count(F.when(F.col("status") == "PASSED", 1))).alias("passed"),
        failed("CRITICAL").alias("critical"),
        failed("WARNING").alias("warnings"),
    )
    return by.withColumn("status", F.when(F.col("critical") > 0, "FAILED").when(F.col("warnings") > 0, "DEGRADED").otherwise("PASSED"))


class QualityError(RuntimeError):
    """A critical check failed: the load must not start."""


def quality_gate(
    tables: dict[str, tuple[DataFrame, Rules]],
    as_of: str | None = None,
    refs: dict[str, dict[str, tuple[DataFrame, str]]] | None = None,
) -> DataFrame:
    """Checks of all tables; raises when one has failed critically. The report is a row per check."""
    checks = reduce(
        DataFrame.unionByName,
        [run_checks(df, name, rules, as_of, (refs or {}).get(name)) for name, (df, rules) in tables.items()],
    )
    failed = [r["table_name"] for r in summarize(checks).where("status = 'FAILED'").collect()]
    if failed:
        raise QualityError(f"critical checks failed for {', '.join(sorted(failed))}")
    return checks


#: What raw files of each table must hold.
RAW_REQUIRED = {
    "orders": ("order_id", "customer_id", "order_status", "total_cents", "order_created_at"),
    "customers": ("customer_id", "email", "created_at"),
    "products": ("product_id", "sku", "product_name", "base_price_cents"),
    "events": ("event_id", "event_type", "occurred_at"),
    "inventory": ("inventory_id", "product_id", "warehouse_id", "quantity_on_hand", "updated_at"),
}


def csv_cells(lines: DataFrame) -> DataFrame:
    """``lines`` with ``cells``: the trimmed fields of each ``value``; commas inside double quotes divide nothing."""
    # Commas outside quotes get a mark, and the line is split at marked commas.
    split = F.split(F.regexp_replace("value", '("[^"]*")|(,)', "$1\u0001$2"), "\u0001,")
    return lines.withColumn(
        "cells",
        F.transform(split, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "\u0001", ""), '^"|"$', ""))),
    )


def validate_csv(lines: DataFrame, table: str, max_nulls: float = 0.05, max_bad: float = 0.10) -> DataFrame:
    """Per file: rows, malformed rows (another number of fields than the header), missing columns, columns among the
    first three required whose null share is over ``max_nulls``, and the verdict. ``lines``: file, pos (0: header), value."""
    required = RAW_REQUIRED[table]
    cells = csv_cells(lines)
    head = cells.where("pos = 0").select("file", F.col("cells").alias("head"))
    body = cells.where("pos > 0 and trim(value) <> ''").join(head, "file")
    at = lambda c: F.array_position("head", c).cast("int")
    empty = lambda c: F.when(at(c) > 0, F.coalesce(F.get("cells", at(c) - 1), F.lit("")) == "").otherwise(False)
    per = body.groupBy("file").agg(
        big(F.count(F.lit(1))).alias("rows"),
        big(F.count(F.when(F.size("cells") != F.size("head"), 1))).alias("malformed"),
        *[big(F.count(F.when(empty(c), 1))).alias(f"empty_{i}") for i, c in enumerate(required[:3])],
    )
    df = head.join(per, "file", "left").na.fill(0)
    missing = F.filter(F.array(*[F.when(at(c) == 0, F.lit(c)) for c in required]), lambda c: c.isNotNull())
    sparse = F.filter(
        F.array(*[F.when(F.col(f"empty_{i}") > max_nulls * F.col("rows"), F.lit(c)) for i, c in enumerate(required[:3])]),
        lambda c: c.isNotNull(),
    )
    bad = (F.size(missing) > 0) | (F.col("malformed") > max_bad * F.col("rows"))
    return df.select(
        "file",
        F.lit(table).alias("table_name"),
        "rows",
        "malformed",
        F.array_join(missing, ",").alias("missing_columns"),
        F.array_join(sparse, ",").alias("sparse_columns"),
        F.when(bad, "INVALID").otherwise("VALID").alias("status"),
    )


def validate_jsonl(lines: DataFrame, table: str, max_bad: float = 0.05) -> DataFrame:
    """Per file: rows, rows that are no JSON object or lack one of the first three required keys, and the verdict.
    ``lines``: file, value."""
    keys = RAW_REQUIRED[table][:3]
    text = lines.where("trim(value) <> ''")
    parsed = F.try_parse_json("value")
    lacks = F.lit(False)
    for k in keys:
        lacks = lacks | F.get_json_object("value", f"$.{k}").isNull()
    bad = parsed.isNull() | ~F.trim("value").startswith("{") | lacks
    per = text.groupBy("file").agg(big(F.count(F.lit(1))).alias("rows"), big(F.count(F.when(bad, 1))).alias("errors"))
    return per.select(
        "file",
        F.lit(table).alias("table_name"),
        "rows",
        "errors",
        F.when(F.col("errors") > max_bad * F.col("rows"), "INVALID").otherwise("VALID").alias("status"),
    )


def route_files(results: DataFrame) -> DataFrame:
    """Where each judged file goes: processed when valid or Parquet, else quarantine with an alert."""
    ok = (F.col("status") == "VALID") | F.lower("file").endswith(".parquet")
    return results.select("file", "table_name", F.when(ok, "processed").otherwise("quarantine").alias("zone"), (~ok).alias("alert"))


def read_lines(spark, path: str) -> DataFrame:
    """Lines of text files with their file and position (gzip is read as well): 0 for a file's first line, then rising;
    where a file is read in pieces, each piece starts at a higher number than the one before ended."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("id"), "value")
    # One row per file; no task gathers a file's lines.
    first = text.groupBy("file").agg(F.min("id").alias("first"))
    return text.join(first, "file").select("file", "value", (F.col("id") - F.col("first")).alias("pos"))
