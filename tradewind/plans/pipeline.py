"""The batch chain: extract, clean, check, load, publish. Stages are joined by stored tables; a failed check stops the load."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.clean import clean_strings
from tradewind.operators import quality, warehouse
from tradewind.sources import lake

REFRESH_LOG = "mart string, seconds double, row_count long, status string, error string"


def refresh_marts(spark: SparkSession, marts: dict[str, Callable[[], DataFrame]], base: str, version: str) -> DataFrame:
    """Recomputes each mart into a new version folder and counts its rows while they are written; one that fails is
    logged and the others go on."""
    rows = []
    for name, build in marts.items():
        began, seen = time.time(), Observation(name)
        try:
            lake.publish_mart(build().observe(seen, F.count(F.lit(1)).alias("n")), base, name, version)
            rows.append((name, time.time() - began, seen.get["n"], "SUCCESS", None))
        except Exception as e:  # noqa: BLE001  whatever a mart raises goes into the log
            rows.append((name, time.time() - began, None, "ERROR", str(e)[:500]))
    lake.log_rows(spark, f"{base}/refresh_log", rows, REFRESH_LOG)
    return spark.createDataFrame(rows, REFRESH_LOG)


def run(spark: SparkSession, source: DataFrame, table: str, key: str, ts_col: str, rules: quality.Rules, base: str, now: str) -> int:
    """One table: the window since the last run is extracted, cleaned, checked, and appended to the facts without keys
    that are there; the watermark moves after the write. Returns the rows loaded."""
    state = f"{base}/state"
    lo, hi = warehouse.get_watermark(spark, state, table, now).select(F.col("lo").cast("string"), F.col("hi").cast("string")).first()
    part = clean_strings(lake.extract_window(source, ts_col, lo, hi))
    raw = f"{base}/processed/{table}/window={hi.replace(' ', 'T').replace(':', '')}"
    part.write.mode("overwrite").parquet(raw)
    part = spark.read.parquet(raw)
    quality.quality_gate({table: (part, rules)}, as_of=now)
    target = f"{base}/facts/{table}"
    try:
        have = spark.read.parquet(target)
        part = warehouse.append_new(part, have, key)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        part = warehouse.one_each(part, [key])
    before = time.time()
    lake.append_fact(part, target)
    loaded = spark.read.parquet(target).where(F.col("dw_loaded_at") >= F.timestamp_seconds(F.lit(before))).count()
    warehouse.put_watermark(spark, state, table, hi)
    return loaded
