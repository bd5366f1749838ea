"""The lake: extracts by window, partitioned reads and writes, logs, retention.

Base folders are zones: raw, processed, curated, quarantine. Partition columns year, month, day are text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.clean import add_partition_cols
from tradewind.functions.columns import big
from tradewind.functions.store import save

PARTS = ("year", "month", "day")


def extract_window(df: DataFrame, ts_col: str, lo: str, hi: str) -> DataFrame:
    """Rows of the change window (lo, hi]; the filter reaches the scan."""
    at = F.col(ts_col)
    kind = df.schema[ts_col].dataType
    return df.where((at > F.lit(lo).cast(kind)) & (at <= F.lit(hi).cast(kind)))


def in_days(df: DataFrame, ts_col: str, lo: str, hi: str) -> DataFrame:
    """Rows of the half-open window [lo, hi)."""
    at, kind = F.col(ts_col), df.schema[ts_col].dataType
    return df.where((at >= F.lit(lo).cast(kind)) & (at < F.lit(hi).cast(kind)))


def export_window(df: DataFrame, table: str, ts_col: str, lo: str, hi: str, base: str) -> str:
    """Writes [lo, hi) as fully quoted CSV under table/year=/month=/day= of ``lo``; returns the folder."""
    y, m, d = lo[:10].split("-")
    path = f"{base}/{table}/year={y}/month={m}/day={d}"
    in_days(df, ts_col, lo, hi).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)
    return path


def denormalize_orders(orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame, lo: str, hi: str) -> DataFrame:
    """One row per item of the orders changed in (lo, hi], with product and category. Items join on the composite key."""
    changed = extract_window(orders, "updated_at", lo, hi)
    df = changed.join(items, ["order_id", "order_created_at"]).join(products, "product_id")
    return df.join(categories.select("category_id", "category_name"), "category_id", "left")


def export_events(events: DataFrame, day: str) -> DataFrame:
    """One day of events in order of time and session."""
    return events.where(F.col("event_date") == F.lit(day).cast("date")).orderBy("occurred_at", "session_id", "event_id")


def live(df: DataFrame, cols: list[str], deleted: str = "deleted_at") -> DataFrame:
    """Projection of the rows that are not softly deleted."""
    return df.where(F.col(deleted).isNull()).select(*cols)


def write_lake(df: DataFrame, base: str, table: str, ts_col: str | None = None) -> str:
    """Appends Parquet by year, month and day. Rows are dealt by partition first, so each has few files."""
    path = f"{base}/{table}"
    parts = add_partition_cols(df, ts_col)
    parts.repartition(*PARTS).write.mode("append").partitionBy(*PARTS).parquet(path)
    return path


def read_lake(spark: SparkSession, base: str, table: str, day: str | None = None) -> DataFrame:
    """The whole table or one day's partition (pruned); partition columns stay text and are kept."""
    df = spark.read.option("basePath", f"{base}/{table}").parquet(f"{base}/{table}")
    df = df.withColumns(
        {
            "year": F.lpad(F.col("year").cast("string"), 4, "0"),
            "month": F.lpad(F.col("month").cast("string"), 2, "0"),
            "day": F.lpad(F.col("day").cast("string"), 2, "0"),
        },
    )
    return prune(df, day)


def prune(df: DataFrame, day: str | None) -> DataFrame:
    if day is None:
        return df
    y, m, d = day.split("-")
    return df.where((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))


#: The columns of the four processed tables and of raw events (timestamps are text there).
PROCESSED = {
    "orders": """order_id string, order_number string, customer_id string, order_status string, payment_status string, payment_method string,
        subtotal_cents bigint, discount_cents bigint, shipping_cents bigint, tax_cents bigint, total_cents bigint, discount_code string,
        shipping_country string, shipping_city string, shipping_state string, order_created_at timestamp, confirmed_at timestamp,
        shipped_at timestamp, delivered_at timestamp, item_id bigint, product_id string, product_sku string, product_name string, quantity int,
        unit_price_cents bigint, item_discount_cents bigint, item_total_cents bigint, category_id int, category_name string, brand string""",
    "events": """event_id string, session_id string, customer_id string, anonymous_id string, event_type string, occurred_at timestamp,
        page_url string, page_title string, referrer_url string, product_id string, order_id string, search_query string, properties_json string""",
    "customers": """customer_id string, email string, email_verified boolean, first_name string, last_name string, phone string,
        country_code string, city string, state_province string, postal_code string, is_active boolean, is_guest boolean, marketing_opt_in boolean,
        acquisition_source string, acquisition_medium string, loyalty_points int, loyalty_tier string, created_at timestamp,
        updated_at timestamp, last_login_at timestamp""",
    "products": """product_id string, sku string, name string, category_id int, category_name string, brand string, base_price_cents int,
        sale_price_cents int, cost_price_cents int, is_active boolean, is_digital boolean, review_count int, avg_rating double,
        created_at timestamp, updated_at timestamp""",
}
RAW = {"events": PROCESSED["events"].replace("occurred_at timestamp", "occurred_at string")}
_DAYS = ", year string, month string, day string"


def declared(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the table's declared columns, in order and of their types; those it lacks are null."""
    kinds = df.sparkSession.createDataFrame([], PROCESSED[table]).schema.fields
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds])


def register_lake(spark: SparkSession, base: str, tables: dict[str, str] | None = None, raw: dict[str, str] | None = None) -> None:
    """Views over the Parquet tables of the processed zone (name: DDL), with text partition columns year, month and day,
    and as ``raw_`` over quoted CSV of the raw zone (header skipped, timestamps left as text)."""
    for t, ddl in (PROCESSED if tables is None else tables).items():
        spark.read.schema(ddl + _DAYS).parquet(f"{base}/processed/{t}").createOrReplaceTempView(t)
    for t, ddl in (RAW if raw is None else raw).items():
        spark.read.schema(ddl + _DAYS).option("header", True).csv(f"{base}/raw/{t}").createOrReplaceTempView(f"raw_{t}")


def lake_join_dim(lake: DataFrame, dc: DataFrame, year: str, month: str) -> DataFrame:
    """Customers and revenue per country and tier of one month's partitions, joined with the warehouse dimension."""
    df = lake.where((F.col("year") == year) & (F.col("month") == month)).join(
        dc.select("customer_key", "country_code", "loyalty_tier"),
        "customer_key",
    )
    return df.groupBy("country_code", "loyalty_tier").agg(
        big(F.count_distinct("customer_key")).alias("customers"),
        big(F.sum("total_cents")).alias("revenue_cents"),
    )


def append_fact(df: DataFrame, path: str) -> None:
    """Appends with the load time."""
    df.withColumn("dw_loaded_at", F.current_timestamp()).write.mode("append").parquet(path)


def quarantine(df: DataFrame, table: str, base: str, reason: str, at: str) -> str:
    """Appends rejected rows with reason and time under table/YYYY/MM/DD/HHMMSS of ``at`` (yyyy-MM-dd HH:mm:ss)."""
    day, time = at.split(" ")
    path = f"{base}/{table}/{day.replace('-', '/')}/{time.replace(':', '')}"
    df.withColumn("quarantine_reason", F.lit(reason)).withColumn("quarantined_at", F.lit(at).cast("timestamp")).write.mode(
        "append",
    ).parquet(path)
    return path


def write_report(report: DataFrame, base: str, run_id: str, at: str, keep_days: int = 90) -> str:
    """Report rows as JSON by table and date, with an expiry."""
    day = F.lit(at).cast("timestamp")
    out = report.withColumns(
        {"run_id": F.lit(run_id), "created_at": day, "expires_at": day + F.make_interval(days=F.lit(keep_days)), "date": F.lit(at[:10])},
    )
    out.write.mode("append").partitionBy("table_name", "date").json(base)
    return base


def export_csv(df: DataFrame, path: str) -> None:
    """A report result, which is small, as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_all(tables: dict[str, tuple[DataFrame, str, int]], day: str, base: str) -> list[tuple[str, int]]:
    """Exports each table (frame, time column, hours back from the day's end); rows are counted while they are written."""
    end = date.fromisoformat(day) + timedelta(days=1)
    counts = []
    for name, (df, ts, hours) in tables.items():
        seen = Observation(name)
        lo = F.lit(f"{end} 00:00:00").cast("timestamp") - F.make_interval(hours=F.lit(hours))
        part = df.where((F.col(ts) >= lo) & (F.col(ts) < F.lit(f"{end} 00:00:00").cast("timestamp"))).observe(
            seen,
            F.count(F.lit(1)).alias("n"),
        )
        part.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(f"{base}/{name}/{day}")
        counts.append((name, seen.get["n"]))
    return counts


class Export(NamedTuple):
    """One export: a frame (or what makes it), and for a windowed one its time column and the hours back from ``day``'s end."""

    name: str
    frame: DataFrame | Callable[[], DataFrame]
    ts_col: str | None = None
    hours: int = 24
    day: str | None = None


def bytes_under(spark: SparkSession, path: str) -> int:
    """Size of all files in a folder, as the file system counts it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def export_jobs(spark: SparkSession, jobs: list[Export], base: str, log: str, run_day: str, quote_all: bool = True, single: bool = False) -> DataFrame:
    """Runs each export to CSV under base/name/day and appends its row to the log: window, rows, bytes, path, start, end,
    status, error. Rows are counted while they are written; an export that fails is logged, with the folder it may have
    begun, and the others go on. Returns the rows."""
    rows = []
    for job in jobs:
        day = job.day or run_day
        path, began = f"{base}/{job.name}/{day}", datetime.now(UTC).replace(tzinfo=None)
        lo = hi = None
        try:
            df = job.frame() if callable(job.frame) else job.frame
            if job.ts_col:
                end = datetime.fromisoformat(day) + timedelta(days=1)
                lo, hi = f"{end - timedelta(hours=job.hours)}", f"{end}"
                df = in_days(df, job.ts_col, lo, hi)
            seen = Observation(job.name)
            df = df.observe(seen, F.count(F.lit(1)).alias("n"))
            out = (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True)
            out.option("quoteAll", quote_all).csv(path)
            end = (seen.get["n"], bytes_under(spark, path), "SUCCESS", None)
        except Exception as e:  # noqa: BLE001  whatever an export raises goes into the log
            end = (None, None, "FAILED", str(e)[:500])
        n, size, status, error = end
        rows.append((job.name, lo, hi, n, size, path, began, datetime.now(UTC).replace(tzinfo=None), status, error))
    log_rows(spark, log, rows, EXPORT_LOG)
    return spark.createDataFrame(rows, EXPORT_LOG)


def export_reports(spark: SparkSession, reports: dict[str, Callable[[], DataFrame]], base: str, log: str, day: str, like: str = "") -> DataFrame:
    """Runs all reports, or those whose name has ``like`` in it, to one CSV file each; a report is small. Returns the log."""
    some = [Export(name, make) for name, make in reports.items() if like.lower() in name.lower()]
    return export_jobs(spark, some, base, log, day, quote_all=False, single=True)


def log_rows(spark: SparkSession, path: str, rows: list[tuple], ddl: str) -> None:
    """Appends audit rows (exports, refreshes, maintenance)."""
    spark.createDataFrame(rows, ddl).withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


EXPORT_LOG = (
    "table_name string, window_start string, window_end string, row_count long, bytes long, path string, started_at timestamp_ntz, "
    "ended_at timestamp_ntz, status string, error string"
)
ARCHIVE_LOG = "table_name string, partition_name string, row_count long, path string"
MAINTENANCE_LOG = "table_name string, partition_name string, action string"


MANIFEST = "version string, seq long, rows long, published_at timestamp"
DAYS_MANIFEST = "day date, version string, seq long"


def _manifest(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """What has been published; empty at first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(ddl).parquet(path) if there else spark.createDataFrame([], ddl)


def _next(manifest: DataFrame) -> int:
    return (manifest.agg(F.max("seq")).first()[0] or 0) + 1


def publish_mart(df: DataFrame, base: str, name: str, version: str) -> str:
    """Writes a mart as a new version folder, then names it in the manifest: readers go by the manifest, so they stay on
    the old version until the new one is whole, and for good if it fails. Nothing is overwritten while it is read."""
    spark, path, seen = df.sparkSession, f"{base}/{name}/version={version}", Observation(f"published-{name}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    log = f"{base}/{name}/_manifest"
    row = spark.createDataFrame([(version, _next(_manifest(spark, log, MANIFEST)), seen.get["n"])], "version string, seq long, rows long")
    row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(log)
    return path


def mart_version(spark: SparkSession, base: str, name: str) -> str | None:
    """The newest version that was published, or None."""
    return _manifest(spark, f"{base}/{name}/_manifest", MANIFEST).agg(F.max_by("version", "seq")).first()[0]


def read_mart(spark: SparkSession, base: str, name: str, version: str | None = None) -> DataFrame:
    """The published mart, or the version asked for."""
    version = version or mart_version(spark, base, name)
    if version is None:
        raise ValueError(f"no version of {name} has been published")
    return spark.read.parquet(f"{base}/{name}/version={version}")


def changed_days(df: DataFrame, ts_col: str, lo: str | None, hi: str) -> DataFrame:
    """``day``: the days of the rows in the change window (lo, hi]; with ``lo`` None of all rows to ``hi``."""
    changed = extract_window(df, ts_col, lo, hi) if lo else df.where(F.col(ts_col) <= F.lit(hi).cast(df.schema[ts_col].dataType))
    return changed.select(F.col(ts_col).cast("date").alias("day")).distinct()


def refresh_days(days: DataFrame, build: Callable[[DataFrame], DataFrame], base: str, name: str, day_col: str, version: str) -> int:
    """Recomputes a daily mart for ``days`` (``day``) only. ``build`` gets these days and makes the mart's rows for them.

    Each day has its own newest version: rows go to day=/version= folders, by dynamic partition overwrite, so a run that
    is repeated replaces its own folders and touches no other; then the manifest names them. A day without rows any more
    is named as well and reads as empty. Returns the number of days."""
    spark = days.sparkSession
    days = save(days.select("day").where("day is not null"), "changed-days")
    out = build(days)
    out = out.withColumns({"day": F.col(day_col), "version": F.lit(version)}).hint("rebalance", "day")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "version").parquet(f"{base}/{name}/data")
    log = f"{base}/{name}/_days"
    seq = _next(_manifest(spark, log, DAYS_MANIFEST))
    named = days.withColumns({"version": F.lit(version), "seq": F.lit(seq).cast("long")})
    named.coalesce(1).write.mode("append").parquet(log)
    return days.count()


def read_days(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A daily mart as published: of each day its newest version. Folders of other versions are pruned by the join."""
    valid = _manifest(spark, f"{base}/{name}/_days", DAYS_MANIFEST).groupBy("day").agg(F.max_by("version", "seq").alias("version"))
    rows = spark.read.option("basePath", f"{base}/{name}/data").parquet(f"{base}/{name}/data")
    rows = rows.withColumns({"day": F.col("day").cast("date"), "version": F.col("version").cast("string")})
    return rows.join(valid, ["day", "version"]).drop("day", "version")


def partition_inventory(df: DataFrame, ts: str, cols: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """Exact rows and first and last time per partition."""
    return (
        add_partition_cols(df, ts)
        .groupBy(*cols)
        .agg(big(F.count(F.lit(1))).alias("row_count"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))
    )


def partition_gaps(df: DataFrame, ts: str, start: str, end: str, unit: str = "month") -> DataFrame:
    """Months or days of the range without data."""
    step = {"month": "interval 1 month", "day": "interval 1 day"}[unit]
    expected = df.sparkSession.range(1).select(F.explode(F.expr(f"sequence(date '{start}', date '{end}', {step})")).alias("part"))
    have = df.select(
        F.trunc(F.col(ts).cast("date"), "month").alias("part") if unit == "month" else F.col(ts).cast("date").alias("part"),
    ).distinct()
    return expected.join(have, "part", "left_anti")


def expired_partitions(df: DataFrame, ts: str, months: int, as_of: str | None = None) -> DataFrame:
    """Monthly partitions that end before ``months`` ago (by default from the newest row), with their rows."""
    parts = df.groupBy(F.trunc(F.col(ts).cast("date"), "month").alias("part")).agg(big(F.count(F.lit(1))).alias("row_count"))
    now = df.agg(F.max(F.col(ts)).cast("date").alias("now")) if as_of is None else df.sparkSession.range(1).select(
        F.lit(as_of).cast("date").alias("now"),
    )
    return parts.crossJoin(F.broadcast(now)).where(F.add_months("part", 1) <= F.add_months("now", -months)).select("part", "row_count")


def months_from_days(days: int, rule: str = "ceil") -> int:
    """Retention in days as whole months: rounded up, or down with at least one."""
    return -(-days // 30) if rule == "ceil" else max(1, days // 30)


def archive_old(spark: SparkSession, base: str, table: str, archive: str, as_of: str, years: int = 2, dry_run: bool = False) -> list[
    tuple[str, int]
]:
    """Moves the months of a lake table before the month ``years`` ago to CSV with a header; returns (partition, rows).

    What was written is read back and counted by month; only if every count is right are the partitions dropped and the
    moves logged under ``archive``/log. A dry run only counts.
    """
    cut = F.date_format(F.add_months(F.lit(as_of).cast("date"), -12 * years), "yyyy-MM")
    month = F.concat_ws("-", "year", "month")
    count = lambda df: {(r["year"], r["month"]): r["n"] for r in df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).collect()}
    old = read_lake(spark, base, table).where(month < cut)
    rows = count(old)
    moved = [(f"{table}_{y}_{m}", n) for (y, m), n in sorted(rows.items())]
    if dry_run or not rows:
        return moved
    path = f"{archive}/{as_of}/{table}"
    old.write.mode("overwrite").partitionBy("year", "month").option("header", True).option("quoteAll", True).csv(path)
    text = spark.read.schema(", ".join(f"`{c}` string" for c in [*(c for c in old.columns if c not in ("year", "month")), "year", "month"]))
    if count(text.option("header", True).option("multiLine", True).csv(path)) != rows:
        raise RuntimeError(f"the archive at {path} does not hold all rows: nothing was dropped")
    for y, m in rows:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{table}/year={y}/month={m}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    log_rows(spark, f"{archive}/log", [(table, name, n, path) for name, n in moved], ARCHIVE_LOG)
    return moved


def register_partitions(spark: SparkSession, table: str, base: str, parts: list[tuple[str, str, str]], chunk: int = 100) -> int:
    """Adds date partitions to a catalog table, those it has are left alone."""
    for lo in range(0, len(parts), chunk):
        each = " ".join(
            f"PARTITION (year='{y}', month='{m}', day='{d}') LOCATION '{base}/year={y}/month={m}/day={d}'" for y, m, d in parts[
                lo : lo + chunk
            ]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {each}")
    return len(parts)
