"""Queries for databases, the catalog, exports, marts by change, and streams of files, events and identities, with DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import big
from tradewind.operators import marketing
from tradewind.plans import operations as ops
from tradewind.plans.analytics import QUERIES, SQL, add
from tradewind.sources import catalog, jdbc, lake
from tradewind.sources.conform import dim_customers, dim_products, fact_events, fact_orders, inventory, order_heads
from tradewind.streaming import events as stream
from tradewind.streaming import files, identity

# --- databases --------------------------------------------------------------------------------------------------------


def database(spark: SparkSession) -> str:
    """The database of ``tradewind.jdbc.url``; where that is unset a new one in memory, which a single machine sees."""
    return spark.conf.get("tradewind.jdbc.url", f"jdbc:derby:memory:shop{uuid.uuid4().hex};create=true")


_ORDERS = "order_id bigint, customer_key bigint, created_at timestamp, status varchar(20), total_cents bigint"


@add(
    "jdbc_extract",
    f"""select h.order_id, h.customer_key, h.created_at, h.status, h.total_cents, l.items from oh h
  join (select order_id, cast(count(*) as bigint) as items from fo group by 1) l using (order_id)
  where h.created_at > timestamp '{ops.LO}' and h.created_at <= timestamp '{ops.HI}'""",
    "fo oh",
)
def _jdbc(s: SparkSession, d: str) -> DataFrame:
    """Orders loaded into a database, a window of them extracted in ranges, and joined with the items in the lake."""
    url, table, base = database(s), f"orders_{uuid.uuid4().hex[:12]}", ops.scratch(s)
    heads = order_heads(s, d).select("order_id", "customer_key", F.col("created_at").cast("timestamp").alias("created_at"), "status", "total_cents")
    jdbc.load_jdbc(heads, url, table, _ORDERS.replace("timestamp,", "TIMESTAMP,"), mode="overwrite")
    lake.write_lake(fact_orders(s, d).select("order_id", "product_key", "ordered_at"), base, "items", "ordered_at")
    items = lake.read_lake(s, base, "items").groupBy("order_id").agg(big(F.count(F.lit(1))).alias("items"))
    window = jdbc.extract_jdbc(s, url, table, "created_at", ops.LO, ops.HI, "order_id").toDF("order_id", "customer_key", "created_at", "status", "total_cents")
    return window.join(items, "order_id").withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@add("jdbc_append", "select order_id, cast(total_cents as bigint) as total_cents from oh where total_cents is not null", "oh")
def _jdbc_append(s: SparkSession, d: str) -> DataFrame:
    """Two extracts of consecutive windows appended to a second table: no order twice, none left out."""
    url, table = database(s), f"heads_{uuid.uuid4().hex[:12]}"
    heads = order_heads(s, d).select("order_id", F.col("created_at").cast("timestamp").alias("created_at"), "total_cents")
    jdbc.load_jdbc(heads, url, table, mode="overwrite")
    for lo, hi in ((None, ops.LO), (ops.LO, None)):
        jdbc.load_jdbc(jdbc.extract_jdbc(s, url, table, "created_at", lo, hi, "order_id"), url, f"{table}_copy")
    return jdbc.jdbc_table(s, url, f"{table}_copy").toDF("order_id", "created_at", "total_cents").drop("created_at")


# --- the catalog --------------------------------------------------------------------------------------------------------


def _catalogued(s: SparkSession, d: str) -> tuple[str, str]:
    base, name = ops.scratch(s), f"lake_{uuid.uuid4().hex}"
    lake.write_lake(order_heads(s, d).select("order_id", "customer_key", "created_at", "status", "total_cents"), base, "orders", "created_at")
    catalog.create_table(s, name, "order_id bigint, customer_key bigint, created_at timestamp_ntz, status string, total_cents bigint", f"{base}/orders")
    return base, name


_OLD = "date_trunc('month', created_at) + interval 1 month <= timestamp '2001-08-01' - interval 24 month"


@add(
    "drop_partitions",
    f"""select strftime(created_at, '%Y-%m') as part, cast(count(distinct created_at::date) as bigint) as days, cast(count(*) as bigint) as row_count,
  case when {_OLD} then 'dropped' else 'kept' end as state from oh group by 1, 4""",
    "oh",
)
def _dropped(s: SparkSession, d: str) -> DataFrame:
    """Days of expired months leave catalog and storage; a dry run before changes nothing."""
    base, name = _catalogued(s, d)
    rows = s.table(name).groupBy("year", "month", "day").agg(big(F.count(F.lit(1))).alias("n"))
    before = lake.save(rows, "partitions-before")
    planned = catalog.drop_expired(s, name, f"{base}/orders", 24, "2001-08-01", f"{base}/log", dry_run=True)
    catalog.drop_expired(s, name, f"{base}/orders", 24, "2001-08-01", f"{base}/log")
    catalog.repair(s, name)
    left = s.table(name).groupBy("year", "month", "day").agg(big(F.count(F.lit(1))).alias("n"))
    log = s.read.parquet(f"{base}/log").select(*[F.split("partition_name", "-")[i].alias(c) for i, c in enumerate(lake.PARTS)])
    plan = s.createDataFrame([p.split("-") for _, p, _ in planned], "year string, month string, day string")
    # A day counts as dropped if the dry run named it, the log has it, and storage no longer does.
    gone = before.join(log.intersectAll(plan), list(lake.PARTS)).join(left, list(lake.PARTS), "left_anti")
    out = gone.withColumn("state", F.lit("dropped")).unionByName(left.withColumn("state", F.lit("kept")))
    return out.groupBy(F.concat_ws("-", "year", "month").alias("part"), "state").agg(big(F.count(F.lit(1))).alias("days"), F.sum("n").alias("row_count"))


add(
    "catalog_partition",
    "select order_id, customer_key, total_cents from oh where created_at::date = date '2001-02-03'",
    "oh",
)(lambda s, d: s.table(_catalogued(s, d)[1]).where("year = '2001' and month = '02' and day = '03'").select("order_id", "customer_key", "total_cents"))

# --- exports -------------------------------------------------------------------------------------------------------------


def _five(s: SparkSession, d: str) -> list[lake.Export]:
    """The scheduled exports. Orders and events of the given tables lie years apart, so each has its day."""
    return [
        lake.Export("events", lambda: fact_events(s, d), "occurred_at", 24, "2024-01-15"),
        lake.Export("orders", lambda: order_heads(s, d), "created_at", 25, "2001-07-30"),
        lake.Export("customers", lambda: lake.live(ops._deleted(dim_customers(s, d), "customer_key"), ["customer_key", "email", "loyalty_tier"])),
        lake.Export("products", lambda: lake.live(ops._deleted(dim_products(s, d), "product_key"), ["product_key", "sku", "base_price_cents"])),
        lake.Export("inventory", lambda: inventory(s, d)),
    ]


_COUNTS = """select 'events' as table_name, '2024-01-15 00:00:00' as window_start, '2024-01-16 00:00:00' as window_end, cast(count(*) as bigint) as row_count
  from fe where event_date = date '2024-01-15'
  union all select 'orders', '2001-07-29 23:00:00', '2001-07-31 00:00:00', count(*) from oh where created_at >= timestamp '2001-07-29 23:00:00'
    and created_at < timestamp '2001-07-31'
  union all select 'customers', null, null, count(*) from dc where customer_key % 9 <> 0
  union all select 'products', null, null, count(*) from dp where product_key % 9 <> 0
  union all select 'inventory', null, null, count(*) from inv"""


@add(
    "scheduled_export_all",
    f"""with c as ({_COUNTS}) select *, 'SUCCESS' as status, row_count > 0 as has_bytes, true as ended, null::varchar as error from c
  union all select 'broken', null, null, null, 'FAILED', null, true, 'error'""",
    "fe oh dc dp inv",
)
def _exports(s: SparkSession, d: str) -> DataFrame:
    """All five exports and one that fails, as their log has them; what lies in the folders is counted again."""
    base = ops.scratch(s)
    broken = lake.Export("broken", lambda: s.sql("select raise_error('no such table') as x"))
    lake.export_jobs(s, [*_five(s, d), broken], base, f"{base}/log", "2001-07-31")
    log = s.read.parquet(f"{base}/log")
    parts = [s.read.option("header", True).csv(r.path).agg(big(F.count(F.lit(1))).alias("lines")).withColumn("table_name", F.lit(r.table_name)) for r in log.where("status = 'SUCCESS'").collect()]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    log = log.join(found, "table_name", "left")
    error = F.when(F.col("error").isNotNull(), "error")
    return log.select("table_name", "window_start", "window_end", F.col("lines").alias("row_count"), "status", (F.col("bytes") > 0).alias("has_bytes"), (F.col("ended_at") >= F.col("started_at")).alias("ended"), error.alias("error"))


REPORTS = ("monthly_revenue", "rfm_report", "top_products", "cohort_pivot", "geo_top15", "funnel_steps", "inventory_health")
_REPORT_COUNT = "select '{what}' as run, '{r}' as table_name, cast((select count(*) from ({sql})) as bigint) as row_count, 'SUCCESS' as status"


@add(
    "export_reports",
    " union all ".join(
        [_REPORT_COUNT.format(what="all", r=r, sql=SQL[r]) for r in REPORTS]
        + [_REPORT_COUNT.format(what="top", r=r, sql=SQL[r]) for r in REPORTS if "top" in r],
    ),
)
def _reports(s: SparkSession, d: str) -> DataFrame:
    """All reports as CSV, and then those whose name has ``TOP`` in it."""
    made, base = {r: (lambda r=r: QUERIES[r](s, d)) for r in REPORTS}, ops.scratch(s)
    all_ = lake.export_reports(s, made, f"{base}/all", f"{base}/log", "2001-08-01")
    some = lake.export_reports(s, made, f"{base}/top", f"{base}/log", "2001-08-01", like="TOP")
    return all_.withColumn("run", F.lit("all")).unionByName(some.withColumn("run", F.lit("top"))).select("run", "table_name", "row_count", "status")


# --- marts by change -----------------------------------------------------------------------------------------------------

CHANGE = ("2024-01-20 12:00:00", "2100-01-01 00:00:00")


@add("mart_by_change", SQL["funnel_daily"])
def _by_change(s: SparkSession, d: str) -> DataFrame:
    """The daily funnel published up to a time, then refreshed for the days that changed after it only."""
    base, fe = ops.scratch(s), fact_events(s, d)

    def upto(events: DataFrame):
        return lambda days: marketing.funnel_daily(events.join(days.withColumnRenamed("day", "event_date"), "event_date", "left_semi"))

    early = fe.where(F.col("occurred_at") <= F.lit(CHANGE[0]).cast("timestamp_ntz"))
    lake.refresh_days(lake.changed_days(fe, "occurred_at", None, CHANGE[0]), upto(early), base, "funnel", "event_date", "1")
    lake.refresh_days(lake.changed_days(fe, "occurred_at", *CHANGE), upto(fe), base, "funnel", "event_date", "2")
    return lake.read_days(s, base, "funnel")


@add("mart_versions", "select order_status, cast(count(*) as bigint) as n from fo group by 1", "fo")
def _versions(s: SparkSession, d: str) -> DataFrame:
    """A second version that fails half-way: readers stay on the first."""
    base = ops.scratch(s)
    good = fact_orders(s, d).groupBy("order_status").agg(big(F.count(F.lit(1))).alias("n"))
    lake.publish_mart(good, base, "status", "1")
    try:
        lake.publish_mart(good.withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("broken"))).cast("bigint")), base, "status", "2")
    except Exception as e:
        if "broken" not in str(e):
            raise
    return lake.read_mart(s, base, "status")


# --- streams -------------------------------------------------------------------------------------------------------------

_V, _F = f"cast(sum({ops._TIMES}) filter ({ops._OK}) as bigint)", f"cast(sum({ops._TIMES}) filter (not ({ops._OK})) as bigint)"


@add(
    "stream_redelivery",
    f"""select run, 2 * {_V} as valid, case when run = 'a' then {_V} else 0 end as inserted, {_V} + {_F} as repeats, 2 * {_F} as failed,
  {_V} + {_F} as state_rows from events, (values ('a'), ('b')) t(run) group by run""",
)
def _redelivered(s: SparkSession, d: str) -> DataFrame:
    """Every message delivered twice: the state drops the second delivery; a run without that state finds all in the target."""
    base = ops.scratch(s)
    for _ in range(2):
        ops.messages(s, d).repartition(4, "message_id").write.mode("append").json(f"{base}/in")
    for run in ("a", "b"):
        raw = s.readStream.schema("message_id string, body string").option("maxFilesPerTrigger", 5).json(f"{base}/in")
        stream.start_ingest(raw, f"{base}/events", f"{base}/letters/{run}", f"{base}/log/run={run}", f"{base}/checkpoint-{run}", once=True).awaitTermination()
    log = s.read.option("basePath", f"{base}/log").parquet(f"{base}/log").where("status = 'done'")
    sums = [F.sum(c).alias(c) for c in ("valid", "inserted", "repeats", "failed")]
    return log.groupBy("run").agg(*sums, F.max_by("state_rows", "batch").alias("state_rows"))


@add("identity_stream", SQL["identity_stitch"])
def _identities(s: SparkSession, d: str) -> DataFrame:
    """Half of the events come before most identities are known; the late pass gives what the batch gives."""
    base = ops.scratch(s)
    events = fact_events(s, d).withColumn("anonymous_id", F.concat(F.lit("a"), (F.col("customer_key") % 97).cast("string")))
    known = F.when(F.col("event_id") % 3 > 0, F.col("customer_key")).alias("customer_key")
    sessions = events.select("anonymous_id", known, F.col("occurred_at").alias("started_at"), "event_date")
    rows = events.select("event_id", "anonymous_id", F.when(F.col("event_id") % 2 > 0, F.col("customer_key")).alias("customer_key"), "event_date")
    for part, (version, seen) in enumerate((("1", "event_date < date '2024-01-10'"), ("2", "event_date is not null"))):
        new = "event_date < date '2024-01-16'" if part == 0 else "event_date >= date '2024-01-16'"
        rows.where(new).drop("event_date").write.mode("append").parquet(f"{base}/in")
        identity.publish_identities(sessions.where(seen), base, version)
        raw = s.readStream.schema("event_id long, anonymous_id string, customer_key long").parquet(f"{base}/in")
        identity.start_stitching(raw, base, f"{base}/out", f"{base}/checkpoint", once=True).awaitTermination()
    identity.late_pass(s, base, f"{base}/out")
    return identity.read_stitched(s, f"{base}/out").select("event_id", "anonymous_id", "customer_key")


def _routed(s: SparkSession, d: str, kind: str) -> str:
    """A drop folder with a file per event type, streamed to the zones; a second run must find nothing."""
    base = ops.scratch(s)
    lines = ops._files(s, d, kind)
    order = ["pos"] if kind == "csv" else []
    # One file per type, its header first.
    dealt = lines.repartition("file").sortWithinPartitions("file", *order)
    dealt.select("value", F.col("file").alias("kind")).write.partitionBy("kind").text(f"{base}/drop")
    for _ in range(2):
        files.start_routing(s, f"{base}/drop/*", base, "events", kind, f"{base}/checkpoint", once=True).awaitTermination()
    return base


def _zones(s: SparkSession, d: str, kind: str) -> DataFrame:
    base, name = _routed(s, d, kind), F.regexp_extract("file", "kind=([^/]+)/", 1).alias("file")
    read = lambda zone: s.read.parquet(f"{base}/{zone}/events")
    count = lambda df, as_: df.groupBy(name).agg(big(F.count(F.lit(1))).alias(as_))
    report = read("reports").select(name, "rows", "status")
    out = report.join(count(read("processed"), "processed"), "file", "left").join(count(read("quarantine"), "quarantined"), "file", "left")
    return out.join(count(read("alerts"), "alerts"), "file", "left").na.fill(0)


_ZONES = f"""with f as (select event_type as file, cast(count(*) as bigint) as rows, {ops._BROKEN} as bad from fe group by 1)
select file, rows, case when bad > {{most}} * rows then 'INVALID' else 'VALID' end as status,
  case when bad > {{most}} * rows then 0 else rows - bad end as processed, case when bad > {{most}} * rows then rows + {{head}} else 0 end as quarantined,
  cast(bad > {{most}} * rows as bigint) as alerts from f"""
add("route_csv_stream", _ZONES.format(most=0.1, head=1), "fe")(lambda s, d: _zones(s, d, "csv"))
add("route_jsonl_stream", _ZONES.format(most=0.05, head=0), "fe")(lambda s, d: _zones(s, d, "jsonl"))

