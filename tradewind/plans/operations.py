"""Queries for extracts, cleaning, load, quality, streaming rules, order batches and retention, with DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import clean
from tradewind.functions.columns import big
from tradewind.functions.store import save, work_dir
from tradewind.operators import listing, orders, quality, warehouse
from tradewind.plans.analytics import QUERIES as ANALYTICS
from tradewind.plans.analytics import SQL as ANALYTICS_SQL
from tradewind.plans.analytics import add as _add
from tradewind.plans.analytics import snapshots
from tradewind.sources import lake
from tradewind.sources.conform import CODE, TIER, dim_customers, dim_products, fact_events, fact_orders, inventory, order_heads, read
from tradewind.streaming import events as stream


def add(name: str, sql: str | None, tables: str = ""):
    return _add(name, sql, tables)


def scratch(spark: SparkSession) -> str:
    """A new folder for what a query writes: in the shared checkpoint folder, a temporary one only where that is unset."""
    return f"{work_dir(spark)}/{uuid.uuid4().hex}"


# --- sources and sinks ---------------------------------------------------------------------------------------------

LO, HI = "2001-01-01 00:00:00", "2001-03-01 00:00:00"
_HEAD = "order_id, customer_key, created_at, status, total_cents"

add("incremental_extract", f"select {_HEAD} from oh where created_at > timestamp '{LO}' and created_at <= timestamp '{HI}'", "oh")(
    lambda s, d: lake.extract_window(order_heads(s, d), "created_at", LO, HI).select(*_HEAD.split(", ")),
)
add("export_window", f"select {_HEAD} from oh where created_at >= timestamp '{LO}' and created_at < timestamp '{HI}'", "oh")(
    lambda s, d: lake.in_days(order_heads(s, d), "created_at", LO, HI).select(*_HEAD.split(", ")),
)


@add("orders_denormalized", f"""select order_id, order_created_at, status, product_key as product_id, quantity, total_cents, sku,
  product_name, base_price_cents, category_name from (select order_id, created_at as order_created_at, status from oh
  where created_at > timestamp '{LO}' and created_at <= timestamp '{HI}')
 join (select order_id, ordered_at as order_created_at, product_key, quantity, total_cents from fo) using (order_id, order_created_at)
   join dp using (product_key)""", "oh dp")
def _denormalized(s: SparkSession, d: str) -> DataFrame:
    heads = order_heads(s, d).select(
        "order_id",
        F.col("created_at").alias("order_created_at"),
        "status",
        F.col("created_at").alias("updated_at"),
    )
    items = fact_orders(s, d).select(
        "order_id",
        F.col("ordered_at").alias("order_created_at"),
        F.col("product_key").alias("product_id"),
        "quantity",
        "total_cents",
    )
    dp = dim_products(s, d)
    products = dp.select(
        F.col("product_key").alias("product_id"),
        "sku",
        "product_name",
        "base_price_cents",
        F.col("category_name").alias("category_id"),
    )
    categories = dp.select(F.col("category_name").alias("category_id"), "category_name").distinct()
    return lake.denormalize_orders(heads, items, products, categories, LO, HI).drop("updated_at", "category_id")


add(
    "events_day_export",
    "select event_id, occurred_at, session_id, event_type, customer_key, props from fe where event_date = date '2024-01-15'",
    "fe",
)(
    lambda s, d: lake.export_events(fact_events(s, d), "2024-01-15").select(
        "event_id",
        "occurred_at",
        "session_id",
        "event_type",
        "customer_key",
        "props",
    ),
)


def _deleted(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("deleted_at", F.when(F.col(key) % 9 == 0, F.lit("2001-01-01")))


add("customers_extract", "select customer_key, email, country_code, loyalty_tier from dc where customer_key % 9 <> 0", "dc")(
    lambda s, d: lake.live(_deleted(dim_customers(s, d), "customer_key"), ["customer_key", "email", "country_code", "loyalty_tier"]),
)
add("products_extract", "select product_key, sku, product_name, category_name, base_price_cents from dp where product_key % 9 <> 0", "dp")(
    lambda s, d: lake.live(
        _deleted(dim_products(s, d), "product_key"),
        ["product_key", "sku", "product_name", "category_name", "base_price_cents"],
    ),
)
add(
    "inventory_extract",
    "select product_key, sku, warehouse_id, quantity_on_hand, quantity_reserved, reorder_point from inv join dp using (product_key)",
    "inv dp",
)(
    lambda s, d: (
        inventory(s, d)
        .join(dim_products(s, d), "product_key")
        .select("product_key", "sku", "warehouse_id", "quantity_on_hand", "quantity_reserved", "reorder_point")
    ),
)


def _lake(s: SparkSession, d: str) -> tuple[str, DataFrame]:
    base = scratch(s)
    lake.write_lake(
        order_heads(s, d).select("order_id", "customer_key", "created_at", "status", "total_cents"),
        base,
        "orders",
        "created_at",
    )
    return base, lake.read_lake(s, base, "orders")


_PARTS = "strftime(created_at, '%Y') as year, strftime(created_at, '%m') as month, strftime(created_at, '%d') as day"
add("write_partitioned", f"select year, month, cast(count(*) as bigint) as row_count from (select {_PARTS} from oh) group by 1, 2", "oh")(
    lambda s, d: _lake(s, d)[1].groupBy("year", "month").agg(big(F.count(F.lit(1))).alias("row_count")),
)
add("read_partition", f"select {_HEAD}, {_PARTS} from oh where created_at::date = date '2001-02-03'", "oh")(
    lambda s, d: lake.prune(_lake(s, d)[1], "2001-02-03"),
)


@add(
    "lake_tables",
    """select 'orders' as table_name, cast(count(*) as bigint) as row_count, cast(sum(total_cents) as bigint) as total,
  min(strftime(ordered_at, '%Y-%m-%d')) as first_day, max(strftime(ordered_at, '%Y-%m-%d')) as last_day from fo
    union all select 'events', count(*), sum(customer_key), min(strftime(occurred_at, '%Y-%m-%d')), max(strftime(occurred_at, '%Y-%m-%d'))
      from fe
    union all select 'customers', count(*), sum(customer_key), min(strftime(customer_since_date, '%Y-%m-%d')),
      max(strftime(customer_since_date, '%Y-%m-%d')) from dc
    union all select 'products', count(*), sum(base_price_cents), '2001-01-01', '2001-01-01' from dp
    union all select 'raw_events', count(*), sum(customer_key), min(strftime(occurred_at, '%Y-%m-%d')), max(strftime(occurred_at,
      '%Y-%m-%d')) from fe""",
    "fo fe dc dp",
)
def _tables(s: SparkSession, d: str) -> DataFrame:
    base = scratch(s)
    text = lambda c: F.col(c).cast("string")
    orders = fact_orders(s, d).withColumns({"order_id": text("order_id"), "order_created_at": F.col("ordered_at").cast("timestamp")})
    events = fact_events(s, d).withColumns(
        {"event_id": text("event_id"), "customer_id": text("customer_key"), "occurred_at": F.col("occurred_at").cast("timestamp")},
    )
    customers = dim_customers(s, d).withColumns(
        {"customer_id": text("customer_key"), "created_at": F.col("customer_since_date").cast("timestamp")},
    )
    products = dim_products(s, d).withColumns({"product_id": text("product_key"), "updated_at": F.lit("2001-01-01").cast("timestamp")})
    for name, df, ts in (
        ("orders", orders, "order_created_at"),
        ("events", events, "occurred_at"),
        ("customers", customers, "created_at"),
        ("products", products, "updated_at"),
    ):
        lake.write_lake(lake.declared(df, name), f"{base}/processed", name, ts)
    raw = clean.add_partition_cols(lake.declared(events, "events"), "occurred_at").withColumn(
        "occurred_at",
        F.col("occurred_at").cast("string"),
    )
    raw.repartition(*lake.PARTS).write.partitionBy(*lake.PARTS).option("header", True).option("quoteAll", True).csv(f"{base}/raw/events")
    lake.register_lake(s, base)
    one = "select '{t}' as table_name, count(*) as row_count, sum({x}) as total, min(concat_ws('-', year, month, day)) as first_day, max(concat_ws('-', year, month, day)) as last_day from {t}"
    sums = {
        "orders": "total_cents",
        "events": "cast(customer_id as bigint)",
        "customers": "cast(customer_id as bigint)",
        "products": "base_price_cents",
        "raw_events": "cast(customer_id as bigint)",
    }
    return s.sql(" union all ".join(one.format(t=t, x=x) for t, x in sums.items()))


add(
    "federated_activity",
    "select country_code, loyalty_tier, cast(count(distinct customer_key) as bigint) as customers, cast(sum(total_cents) as bigint) "
    "as revenue_cents from oh join dc using (customer_key) where strftime(created_at, '%Y-%m') = '2001-01' group by 1, 2",
    "oh dc",
)(lambda s, d: lake.lake_join_dim(clean.add_partition_cols(order_heads(s, d), "created_at"), dim_customers(s, d), "2001", "01"))


@add("warehouse_append", "select order_id, product_key, quantity from fo", "fo")
def _append(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    lake.append_fact(fact_orders(s, d).select("order_id", "product_key", "quantity"), path)
    return s.read.parquet(path).where("dw_loaded_at is not null").select("order_id", "product_key", "quantity")


@add(
    "quarantine_sink",
    "select order_id, product_key, quantity, 'refunded' as quarantine_reason from fo where order_status = 'refunded'",
    "fo",
)
def _quarantined(s: SparkSession, d: str) -> DataFrame:
    path = lake.quarantine(
        fact_orders(s, d).where("order_status = 'refunded'").select("order_id", "product_key", "quantity"),
        "orders",
        scratch(s),
        "refunded",
        "2001-08-01 12:00:00",
    )
    return s.read.parquet(path).drop("quarantined_at")


@add(
    "export_result_csv",
    f"select {', '.join(f'cast({c} as varchar) as {c}' for c in ('year', 'month_name', 'total_orders', 'total_revenue', 'avg_order_value', 'prev_month_revenue', 'mom_growth_pct'))} "
    f"from ({ANALYTICS_SQL['monthly_revenue']})",
)
def _csv(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    report = ANALYTICS["monthly_revenue"](s, d)
    # Doubles as text in one notation for all sizes: two digits, without trailing zeros but for one.
    plain = [
        F.when(F.col(c).isNotNull(), F.regexp_replace(F.format_string("%.2f", c), r"(\.\d)0$", "$1")).alias(c) if k == "double" else F.col(
            c,
        ) for c, k in report.dtypes
    ]
    lake.export_csv(report.select(*plain), path)
    return s.read.option("header", True).csv(path)


@add("scheduled_export", """select 'events' as table_name, cast(count(*) as bigint) as row_count from fe
  where event_date = date '2024-01-15'
    union all select 'orders', cast(count(*) as bigint) from oh where created_at >= timestamp '2001-07-29 23:00:00'
      and created_at < timestamp '2001-07-31'""", "fe oh")
def _scheduled(s: SparkSession, d: str) -> DataFrame:
    # Orders and events of the given tables lie years apart, so each has its day.
    out = lake.export_all({"events": (fact_events(s, d), "occurred_at", 24)}, "2024-01-15", scratch(s))
    out += lake.export_all({"orders": (order_heads(s, d), "created_at", 25)}, "2001-07-30", scratch(s))
    return s.createDataFrame(out, "table_name string, row_count bigint")


@add(
    "export_job_log",
    "select 'events' as table_name, cast(count(*) as bigint) as row_count, 'SUCCESS' as status from fe "
    "where event_date = date '2024-01-15'",
    "fe",
)
def _job_log(s: SparkSession, d: str) -> DataFrame:
    base = scratch(s)
    lake.export_jobs(s, [lake.Export("events", fact_events(s, d), "occurred_at")], base, f"{base}/log", "2024-01-15")
    return s.read.parquet(f"{base}/log").select("table_name", "row_count", "status")


@add("curated_mart_write", "select order_status, cast(count(*) as bigint) as n from fo group by 1", "fo")
def _mart(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(
        lake.publish_mart(fact_orders(s, d).groupBy("order_status").agg(big(F.count(F.lit(1))).alias("n")), scratch(s), "status", "1"),
    )


# --- cleaning and projection -----------------------------------------------------------------------------------------


@add(
    "clean_strings",
    "select customer_key, case when customer_key % 4 = 0 then null when customer_key % 4 = 1 then null "
    "else customer_name end as customer_name, case when trim(city) in ('', 'NULL') then null else city end as city from dc",
    "dc",
)
def _cleaned(s: SparkSession, d: str) -> DataFrame:
    name = (
        F.when(F.col("customer_key") % 4 == 0, "  N/A ")
        .when(F.col("customer_key") % 4 == 1, "   ")
        .otherwise(F.concat(F.lit(" "), F.col("customer_name"), F.lit("  ")))
    )
    return clean.clean_strings(dim_customers(s, d).select("customer_key", name.alias("customer_name"), "city"))


add("utc_timestamps", "select event_id, cast(timezone('UTC', timezone('America/New_York', ts)) as timestamp) as ts from events")(
    lambda s, d: clean.to_utc(read(s, d, "events").select("event_id", "ts"), "America/New_York").withColumn(
        "ts",
        F.col("ts").cast("timestamp_ntz"),
    ),
)
add("partition_columns", f"select order_id, {_PARTS} from oh", "oh")(
    lambda s, d: clean.add_partition_cols(order_heads(s, d).select("order_id", "created_at")).drop("created_at"),
)
add(
    "row_hash",
    "select customer_key, sha256(concat(coalesce(city, ''), '|', coalesce(country_code, ''), '|', coalesce(loyalty_tier, ''))) as "
    "row_hash from dc",
    "dc",
)(lambda s, d: dim_customers(s, d).select("customer_key", clean.row_hash(["loyalty_tier", "country_code", "city"]).alias("row_hash")))
add(
    "generated_columns",
    "select product_key, quantity_on_hand, quantity_reserved, quantity_on_hand - quantity_reserved as quantity_available from inv",
    "inv",
)(lambda s, d: clean.with_generated(inventory(s, d).select("product_key", "quantity_on_hand", "quantity_reserved"), "inventory"))


@add("dim_date", """with b as (select min(o_orderdate)::date as lo, max(o_orderdate)::date as hi
  from orders), t as (select cast(unnest(generate_series(lo::timestamp, hi::timestamp, interval 1 day)) as date) as d
  from b), f as (select d, d - interval 3 month as q from t)
select cast(strftime(d, '%Y%m%d') as bigint) as date_key, d as full_date, dayofweek(d) as day_of_week, dayname(d) as day_name, day(d) as
  day_of_month, dayofyear(d) as day_of_year, weekofyear(d) as week_of_year, month(d) as month_num, monthname(d) as month_name, strftime(d,
  '%b') as month_short, quarter(d) as quarter, year(d) as year,
 strftime(d, '%Y-%m') as year_month, year(q) as fiscal_year, quarter(q) as fiscal_quarter, dayofweek(d) in (0, 6) as is_weekend, false as
   is_holiday, cast(null as varchar) as holiday_name from f""")
def _calendar(s: SparkSession, d: str) -> DataFrame:
    lo, hi = (
        read(s, d, "orders")
        .agg(F.min("o_orderdate").cast("date").cast("string"), F.max("o_orderdate").cast("date").cast("string"))
        .first()
    )
    return clean.date_dim(s, lo, hi)


add(
    "product_list",
    "select product_key, sku, product_name, category_name, base_price_cents from dp where category_name = 'PROMO' "
    "and base_price_cents between 90500 and 200000 and (lower(product_name) like '%ring%' or lower(sku) like '%ring%' or "
    "lower(brand) like '%ring%')",
    "dp",
)(
    lambda s, d: listing.list_products(
        dim_products(s, d),
        category="PROMO",
        active=True,
        min_cents=90500,
        max_cents=200_000,
        search="Ring",
    ).select("product_key", "sku", "product_name", "category_name", "base_price_cents"),
)
add(
    "customer_list",
    "select customer_key, customer_name, email from dc where country_code = 'NATION_3' "
    "and (email ilike '%c1%' or customer_name ilike '%c1%')",
    "dc",
)(
    lambda s, d: listing.list_customers(dim_customers(s, d), country="nation_3", search="C1").select(
        "customer_key",
        "customer_name",
        "email",
    ),
)
add(
    "order_list",
    "select order_id, customer_key, customer_name, email, status, total_cents, created_at from oh join dc using (customer_key) "
    "where status = 'refunded'",
    "oh dc",
)(lambda s, d: listing.list_orders(order_heads(s, d), dim_customers(s, d), status="refunded"))
add(
    "paginate",
    "select product_key, base_price_cents, (select count(*) from dp) as total, greatest(1, cast(ceil((select count(*) "
    "from dp) / 20.0) as bigint)) as pages, cast(3 as bigint) as page from dp "
    "order by base_price_cents desc, product_key limit 20 offset 40",
    "dp",
)(
    lambda s, d: listing.paginate(
        dim_products(s, d).select("product_key", "base_price_cents"),
        [F.desc("base_price_cents"), "product_key"],
        page=3,
    ),
)
add(
    "order_details",
    "select order_id, order_status, ordered_at, customer_key, email, customer_name, country_code, quantity, unit_price_cents, "
    "quantity * unit_price_cents as line_total_cents, product_key, sku, product_name, category_name from fo "
    "join dc using (customer_key) join dp using (product_key)",
    "fo dc dp",
)(lambda s, d: listing.order_details(fact_orders(s, d), dim_customers(s, d), dim_products(s, d)))
add(
    "order_subtotal",
    "select o_orderkey as order_id, cast(coalesce(sum(quantity * unit_price_cents), 0) as bigint) as subtotal_cents from orders left "
    "join fo on order_id = o_orderkey group by 1",
    "fo",
)(lambda s, d: listing.order_subtotal(read(s, d, "orders").select(F.col("o_orderkey").alias("order_id")), fact_orders(s, d)))
add("order_document", """select order_id, customer_key, cast(count(*) as bigint) as n_items, string_agg(sku, ','
  order by product_key, quantity, unit_price_cents) as skus from fo join dp using (product_key) group by 1, 2""", "fo dp")(
    lambda s, d: listing.order_document(fact_orders(s, d), dim_products(s, d)).select(
        "order_id",
        "customer_key",
        big(F.size("items")).alias("n_items"),
        F.array_join("items.sku", ",").alias("skus"),
    ),
)

# --- warehouse load ----------------------------------------------------------------------------------------------------

TRACKED = ["loyalty_tier", "country_code"]


def scd2_sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(dimension, source): of ten keys one changes its tier, one is new, one is gone from the source."""
    dc = dim_customers(s, d).select("customer_key", "loyalty_tier", "country_code")
    dim = dc.where("customer_key % 10 <> 1").withColumns(
        {"effective_from": F.lit("1995-01-01").cast("date"), "effective_to": F.lit(None).cast("date"), "is_current": F.lit(True)},
    )
    source = dc.where("customer_key % 10 <> 2").withColumn(
        "loyalty_tier",
        F.when(F.col("customer_key") % 10 == 0, F.concat(F.col("loyalty_tier"), F.lit("+"))).otherwise(F.col("loyalty_tier")),
    )
    return dim, source


def merged(s: SparkSession, d: str) -> DataFrame:
    dim, source = scd2_sides(s, d)
    return warehouse.scd2_apply(dim, source, ["customer_key"], TRACKED, "2001-08-02")


_DIM = """select customer_key, loyalty_tier, country_code, date '1995-01-01' as effective_from, case when customer_key % 10 = 0
  then date '2001-08-02' end as effective_to, customer_key % 10 <> 0 as is_current from dc where customer_key % 10 <> 1
 union all select customer_key, case when customer_key % 10 = 0 then loyalty_tier || '+'
   else loyalty_tier end, country_code, date '2001-08-02', null, true from dc where customer_key % 10 in (0, 1)"""
add(
    "scd2_diff",
    "select customer_key, case customer_key % 10 when 0 then 'changed' when 1 then 'new' else 'unchanged' end as change from dc "
    "where customer_key % 10 <> 2",
    "dc",
)(lambda s, d: warehouse.scd2_diff(scd2_sides(s, d)[1], scd2_sides(s, d)[0], ["customer_key"], TRACKED))
add("scd2_merge", _DIM, "dc")(merged)
add(
    "scd2_as_of",
    f"with m as ({_DIM}) select f.order_id, f.customer_key, f.day, m.loyalty_tier "
    f"from (select order_id, customer_key, created_at::date + 30 as day from oh) f left join m on m.customer_key = f.customer_key "
    f"and m.effective_from <= f.day and (m.effective_to is null or f.day < m.effective_to)",
    "oh dc",
)(
    lambda s, d: warehouse.as_of_join(
        order_heads(s, d).select("order_id", "customer_key", F.date_add(F.col("created_at").cast("date"), 30).alias("day")),
        merged(s, d),
        "customer_key",
        "day",
    ).select("order_id", "customer_key", "day", "loyalty_tier"),
)


@add(
    "fact_orders_build",
    "select order_id, customer_key, product_key, cast(strftime(order_date, '%Y%m%d') as bigint) as order_date_key, quantity, "
    "total_cents from fo where customer_key % 10 <> 1",
    "fo",
)
def _facts(s: SparkSession, d: str) -> DataFrame:
    fo = fact_orders(s, d).select(
        "order_id",
        F.col("customer_key").alias("customer_id"),
        F.col("product_key").alias("product_id"),
        "order_date",
        "quantity",
        "total_cents",
    )
    dim_c = scd2_sides(s, d)[0].withColumn("customer_id", F.col("customer_key"))
    dim_p = dim_products(s, d).withColumn("product_id", F.col("product_key"))
    return warehouse.map_fact_orders(fo, dim_c, dim_p, _calendar(s, d)).drop("order_date")


add("fact_append_dedup", "select event_id, event_type from fe where event_id % 3 <> 0", "fe")(
    lambda s, d: warehouse.append_new(
        fact_events(s, d).unionByName(fact_events(s, d).where("event_id % 5 = 0")).select("event_id", "event_type"),
        fact_events(s, d).where("event_id % 3 = 0"),
        "event_id",
    ),
)
add("insert_ignore", "select event_id, case when event_id % 2 = 0 then 'kept' else event_type end as event_type from fe", "fe")(
    lambda s, d: warehouse.insert_ignore(
        fact_events(s, d).select("event_id", "event_type"),
        fact_events(s, d).where("event_id % 2 = 0").select("event_id", F.lit("kept").alias("event_type")),
        ["event_id"],
    ),
)
_KEYED = "select o_orderkey, cast(row_number() over (order by o_orderkey % 3 <> 0, o_orderkey) as bigint) as order_sk from orders"


@add("surrogate_keys", _KEYED)
def _keys(s: SparkSession, d: str) -> DataFrame:
    # A third of the orders has keys already; the rest goes on from the largest.
    every = read(s, d, "orders").select("o_orderkey")
    have = warehouse.assign_keys(every.where("o_orderkey % 3 = 0"), ["o_orderkey"], "order_sk")
    return have.unionByName(warehouse.assign_keys(every.where("o_orderkey % 3 <> 0"), ["o_orderkey"], "order_sk", existing=have))


add(
    "dim_geography",
    "select *, cast(row_number() over (order by country_code, state_province, city) as bigint) as geography_key "
    "from (select distinct country_code, state_province, city from dc)",
    "dc",
)(lambda s, d: warehouse.geo_dim(dim_customers(s, d)))
add("fact_events_build", """with u as (select session_id, min(utm_source) as utm_source, min(utm_medium) as utm_medium from fe group by 1)
  select event_id, cast(strftime(occurred_at, '%Y%m%d') as bigint) as event_date_key, case when dc.customer_key is not null
  then fe.customer_key end as customer_key, case when dp.product_key is not null
  then fe.product_key end as product_key, session_id, event_type, occurred_at, u.utm_source, u.utm_medium
 from fe left join u using (session_id) left join (select customer_key from dc
   where customer_key % 10 <> 1) dc on dc.customer_key = fe.customer_key left join (select product_key from dp
   where product_key < 150) dp on dp.product_key = fe.product_key""", "fe dc dp")(
    lambda s, d: warehouse.map_fact_events(
        fact_events(s, d).drop("utm_source", "utm_medium"),
        fact_events(s, d).groupBy("session_id").agg(F.min("utm_source").alias("utm_source"), F.min("utm_medium").alias("utm_medium")),
        dim_customers(s, d).where("customer_key % 10 <> 1"),
        dim_products(s, d).where("product_key < 150"),
    ),
)


@add("watermark_state", "select (select max(created_at) from oh) as lo", "oh")
def _watermark(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    end = order_heads(s, d).agg(F.max("created_at").cast("string")).first()[0]
    warehouse.put_watermark(s, path, "orders", "2000-01-01 00:00:00")
    warehouse.put_watermark(s, path, "orders", end)
    return warehouse.get_watermark(s, path, "orders", "2002-01-01 00:00:00").select(F.col("lo").cast("timestamp_ntz").alias("lo"))


@add("category_parent", "select product_key, concat(category_name, '/', brand) as name, category_name as parent_category from dp", "dp")
def _parents(s: SparkSession, d: str) -> DataFrame:
    dp = dim_products(s, d)
    leaf = dp.select(
        F.concat_ws("/", "category_name", "brand").alias("category_id"),
        F.concat_ws("/", "category_name", "brand").alias("name"),
        F.col("category_name").alias("parent_id"),
    ).distinct()
    top = dp.select(
        F.col("category_name").alias("category_id"),
        F.col("category_name").alias("name"),
        F.lit(None).cast("string").alias("parent_id"),
    ).distinct()
    tree = warehouse.resolve_categories(leaf.union(top))
    return (
        dp.select("product_key", F.concat_ws("/", "category_name", "brand").alias("category_id"))
        .join(tree, "category_id")
        .select("product_key", "name", "parent_category")
    )


# --- quality -----------------------------------------------------------------------------------------------------------

def _check(check: str, column: str, bad: str, critical: str, otherwise: str = "WARNING", table: str = "lineitem", total: str = "") -> str:
    """SQL of one check row, judged from its counts: ``bad`` rows, and the condition under which they are critical."""
    n = total or f"(select count(*) from {table})"
    severity = f"case when {bad} = 0 then 'INFO' when {critical} then 'CRITICAL' else '{otherwise}' end"
    status = f"case when {bad} > 0 then 'FAILED' else 'PASSED' end"
    return f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, {severity} as severity, {status} as status, cast({bad} as bigint) as bad, cast({n} as bigint) as total"


def _rate(bad: str, limit: float, table: str = "lineitem") -> str:
    return f"{bad} / (select count(*) from {table}) > {limit}"


def _count(where: str, table: str = "lineitem") -> str:
    return f"(select count(*) from {table} where {where})"


def _holes(s: SparkSession, d: str) -> DataFrame:
    """Line items with some prices and dates missing."""
    li = read(s, d, "lineitem")
    return li.withColumn("l_tax", F.when(F.col("l_orderkey") % 50 > 0, F.col("l_tax"))).withColumn(
        "l_shipdate",
        F.when(F.col("l_orderkey") % 500 > 0, F.col("l_shipdate")),
    )


_HOLES = {"l_tax": _count("l_orderkey % 50 = 0"), "l_shipdate": _count("l_orderkey % 500 = 0"), "l_orderkey": _count("l_orderkey is null")}
_COLUMNS = "(select count(*) from information_schema.columns where table_name = 'lineitem' and column_name = '{}')"
add("dq_schema", f"select * from ({_check('schema', 'l_color', f'(1 - {_COLUMNS.format("l_color")})', 'true', total='3')}) where bad > 0")(
    lambda s, d: quality.check_schema(read(s, d, "lineitem"), "lineitem", ("l_orderkey", "l_color", "l_tax")),
)
add("dq_null_rate", " union all ".join(_check("null_rate", c, bad, _rate(bad, 0.01)) for c, bad in _HOLES.items()))(
    lambda s, d: quality.check_nulls(_holes(s, d), "lineitem", ("l_tax", "l_shipdate", "l_orderkey"), 0.01),
)
add(
    "dq_range",
    " union all ".join(
        _check("range", c, _count(w), "true") for c, w in (
            ("l_quantity", "l_quantity < 2 or l_quantity > 45"),
            ("l_discount", "l_discount > 1"),
        )
    ),
)(lambda s, d: quality.check_ranges(read(s, d, "lineitem"), "lineitem", {"l_quantity": (2, 45), "l_discount": (None, 1)}))
add("dq_duplicates", _check("duplicates", "l_orderkey", "(select count(*) - count(distinct l_orderkey) from lineitem)", "true"))(
    lambda s, d: quality.check_duplicates(read(s, d, "lineitem"), "lineitem", "l_orderkey"),
)
add(
    "dq_duplicate_rows",
    "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select l_orderkey from lineitem group by 1 "
    "having count(*) > 1)",
)(lambda s, d: quality.duplicate_rows(read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey"))
add(
    "dq_freshness",
    _check(
        "freshness",
        "ts",
        "(select cast(max(ts) < timestamp '2024-03-01' - interval 3 hour as int) from events)",
        "false",
        table="events",
    ),
)(lambda s, d: quality.check_freshness(read(s, d, "events"), "events", "ts", 3, "2024-03-01 00:00:00"))
add(
    "dq_referential",
    _check("referential", "l_partkey", _count("l_partkey not in (select p_partkey from part where p_partkey % 7 <> 0)"), "false"),
)(
    lambda s, d: quality.check_fk(
        read(s, d, "lineitem"),
        "lineitem",
        "l_partkey",
        read(s, d, "part").where("p_partkey % 7 <> 0"),
        "p_partkey",
    ),
)


def _checks(s: SparkSession, d: str) -> DataFrame:
    rules = quality.Rules(("l_orderkey", "l_tax"), ("l_tax", "l_shipdate", "l_orderkey"), {"l_quantity": (1, 50)}, None, 0.05)
    return quality.run_checks(_holes(s, d), "lineitem", rules).unionByName(
        quality.run_checks(
            read(s, d, "orders"),
            "orders",
            quality.Rules(("o_orderkey",), ("o_orderkey",), {"o_totalprice": (0, 100)}, "o_orderkey"),
        ),
    )


_FOUND = " union all ".join([
    _check("schema", "", f"(2 - {_COLUMNS.format('l_orderkey')} - {_COLUMNS.format('l_tax')})", "true"),
    *[_check("null_rate", c, bad, _rate(bad, 0.05)) for c, bad in _HOLES.items()],
    _check("range", "l_quantity", _count("l_quantity < 1 or l_quantity > 50"), "true"),
    _check("schema", "", "0", "true", table="orders"),
    _check("null_rate", "o_orderkey", _count("o_orderkey is null", "orders"), "true", table="orders"),
    _check("range", "o_totalprice", _count("o_totalprice < 0 or o_totalprice > 100", "orders"), "true", table="orders"),
    _check("duplicates", "o_orderkey", "(select count(*) - count(distinct o_orderkey) from orders)", "true", table="orders"),
])
_REPORT = f"""with c as ({_FOUND}), n as (select table_name, cast(count(*) as bigint) as checks, cast(count(*) filter (status = 'PASSED') as
  bigint) as passed,
    cast(count(*) filter (severity = 'CRITICAL') as bigint) as critical, cast(count(*) filter (severity = 'WARNING') as bigint) as warnings
      from c group by 1)
    select *, case when critical > 0 then 'FAILED' when warnings > 0 then 'DEGRADED' else 'PASSED' end as status from n"""
add("dq_report", _REPORT)(lambda s, d: quality.summarize(_checks(s, d)))


@add("quality_report_sink", _REPORT)
def _report(s: SparkSession, d: str) -> DataFrame:
    path = lake.write_report(_checks(s, d), scratch(s), "r1", "2001-08-01 12:00:00")
    return quality.summarize(s.read.schema(quality.SCHEMA).json(path))


@add("dq_gate", f"select table_name as blocked_by from ({_REPORT}) where status = 'FAILED' and table_name = 'orders'")
def _gate(s: SparkSession, d: str) -> DataFrame:
    good = quality.Rules(("p_partkey",), ("p_partkey",), {"p_size": (0, 100)}, "p_partkey")
    bad = quality.Rules(("o_orderkey",), ("o_orderkey",), {"o_totalprice": (0, 100)}, "o_orderkey")
    quality.quality_gate({"part": (read(s, d, "part"), good)})
    try:
        quality.quality_gate({"orders": (read(s, d, "orders"), bad)})
    except quality.QualityError as e:
        return s.createDataFrame([(str(e).rsplit(" ", 1)[1],)], "blocked_by string")
    return s.createDataFrame([], "blocked_by string")


def _files(s: SparkSession, d: str, kind: str) -> DataFrame:
    """Raw files from the events, one per type; in one of them many rows are broken."""
    fe = fact_events(s, d).select(
        "event_type",
        F.col("event_id").cast("string").alias("id"),
        F.col("occurred_at").cast("string").alias("at"),
    )
    broken = (F.col("event_type") == "purchase") & (F.col("id").cast("bigint") % 3 == 0)
    line = F.concat_ws(",", "id", "event_type", "at") if kind == "csv" else F.to_json(
        F.struct(F.col("id").alias("event_id"), "event_type", F.col("at").alias("occurred_at")),
    )
    rows = fe.select(F.col("event_type").alias("file"), F.when(broken, "oops").otherwise(line).alias("value"))
    if kind != "csv":
        return rows
    head = (
        fe.select(F.col("event_type").alias("file"))
        .distinct()
        .select("file", F.lit("event_id,event_type,occurred_at").alias("value"), F.lit(0).alias("pos"))
    )
    return rows.withColumn("pos", F.lit(1)).unionByName(head)


_BROKEN = "cast(count(*) filter (event_type = 'purchase' and event_id % 3 = 0) as bigint)"
add(
    "validate_csv_files",
    f"select event_type as file, 'events' as table_name, cast(count(*) as bigint) as rows, {_BROKEN} as malformed, '' as "
    f"missing_columns, case when {_BROKEN} > 0.05 * count(*) then 'event_type,occurred_at' else '' end as sparse_columns, case "
    f"when {_BROKEN} > 0.1 * count(*) then 'INVALID' else 'VALID' end as status from fe group by 1",
    "fe",
)(lambda s, d: quality.validate_csv(_files(s, d, "csv"), "events"))
add(
    "validate_jsonl_files",
    f"select event_type as file, 'events' as table_name, cast(count(*) as bigint) as rows, {_BROKEN} as errors, case "
    f"when {_BROKEN} > 0.05 * count(*) then 'INVALID' else 'VALID' end as status from fe group by 1",
    "fe",
)(lambda s, d: quality.validate_jsonl(_files(s, d, "jsonl"), "events"))
add(
    "route_files",
    "select distinct event_type as file, 'events' as table_name, case when event_type = 'purchase' then 'quarantine' "
    "else 'processed' end as zone, event_type = 'purchase' as alert from fe",
    "fe",
)(lambda s, d: quality.route_files(quality.validate_jsonl(_files(s, d, "jsonl"), "events")))

# --- streaming rules on a static table ------------------------------------------------------------------------------------


def messages(s: SparkSession, d: str) -> DataFrame:
    """Events as queue messages: two in three as objects, one as an array; some broken, some of unknown type."""
    e = read(s, d, "events").select("event_id", F.col("event_type").alias("t"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))
    kind = (
        F.when(F.col("t") == "view", " Page_View ")
        .when(F.col("t") == "purchase", "purchase")
        .when(F.col("t") == "signup", "session_start")
        .when(F.col("t") == "click", "product_view")
        .otherwise("oops")
    )
    one = F.to_json(F.struct(kind.alias("event_type"), F.concat(F.col("at"), F.lit("Z")).alias("occurred_at")))
    body = (
        F.when(F.col("event_id") % 17 == 0, "not json")
        .when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
        .otherwise(one)
    )
    return e.select(F.col("event_id").cast("string").alias("message_id"), body.alias("body"))


_TYPE = (
    "case event_type when 'view' then 'page_view' when 'purchase' then 'purchase' when 'signup' then 'session_start' when 'click' "
    "then 'product_view' else 'oops' end"
)
_TIMES = "case when event_id % 17 = 0 then 1 when event_id % 3 = 0 then 2 else 1 end"
add(
    "parse_events",
    f"select cast(event_id as varchar) as message_id, cast({_TIMES} as bigint) as n_events, event_id % 17 = 0 as broken from events",
)(
    lambda s, d: (
        stream.parse_events(messages(s, d))
        .groupBy("message_id")
        .agg(big(F.count(F.lit(1))).alias("n_events"), (F.max(F.col("error").isNotNull().cast("int")) == 1).alias("broken"))
    ),
)
add("validate_events", f"""select cast(event_id as varchar) as message_id, pos, case when event_id % 17 > 0 then {_TYPE} end as event_type,
  case when event_id % 17 > 0 then date_trunc('second', ts) end as occurred_at, event_id % 17 = 0 or {_TYPE} = 'oops' as failed
 from (select *, unnest(range({_TIMES})) as pos from events)""")(
    lambda s, d: stream.validate_events(stream.parse_events(messages(s, d)), "2024-02-01 00:00:00").select(
        "message_id",
        big(F.col("pos")).alias("pos"),
        "event_type",
        F.when(F.col("event_type").isNotNull(), F.col("occurred_at")).cast("timestamp_ntz").alias("occurred_at"),
        F.col("error").isNotNull().alias("failed"),
    ),
)
add(
    "dead_letter",
    f"select cast(event_id as varchar) as message_id, case when event_id % 17 = 0 then 'body is not a JSON object or array' "
    f"else 'unknown event_type: oops' end as error from events where event_id % 17 = 0 or {_TYPE} = 'oops'",
)(lambda s, d: stream.dead_letters(stream.validate_events(stream.parse_events(messages(s, d)), "2024-02-01 00:00:00")).drop("body"))


def ingested(s: SparkSession, d: str) -> tuple[str, str, str]:
    """Streams the messages from JSON lines, twice, into a target: the second run must add nothing."""
    base = scratch(s)
    messages(s, d).repartition(4, "message_id").write.json(f"{base}/in")
    for run in ("a", "b"):
        raw = s.readStream.schema("message_id string, body string").option("maxFilesPerTrigger", 2).json(f"{base}/in")
        stream.start_ingest(
            raw,
            f"{base}/events",
            f"{base}/letters-{run}",
            f"{base}/metrics/run={run}",
            f"{base}/checkpoint-{run}",
            once=True,
        ).awaitTermination()
    return f"{base}/events", f"{base}/letters-a", f"{base}/metrics"


_OK = f"event_id % 17 > 0 and {_TYPE} <> 'oops'"
add(
    "stream_insert",
    f"select {_TYPE} as event_type, cast(sum({_TIMES}) as bigint) as n, cast(sum({_TIMES}) as bigint) as n_ids from events "
    f"where {_OK} group by 1",
)(
    lambda s, d: (
        s.read.parquet(ingested(s, d)[0])
        .groupBy("event_type")
        .agg(big(F.count(F.lit(1))).alias("n"), big(F.count_distinct("event_id")).alias("n_ids"))
    ),
)
add("stream_metrics", f"""select run, cast(sum({_TIMES}) filter ({_OK}) as bigint) as valid, cast(case when run = 'a'
  then sum({_TIMES}) filter ({_OK}) else 0 end as bigint) as inserted,
    cast(sum({_TIMES}) filter (not ({_OK})) as bigint) as failed, true as timed from events, (values ('a'), ('b')) t(run) group by run""")(
    lambda s, d: s.read.option("basePath", (m := ingested(s, d)[2])).parquet(f"{m}/run=a", f"{m}/run=b").groupBy("run").agg(F.sum("valid").alias("valid"), F.sum("inserted").alias("inserted"), F.sum("failed").alias("failed"), (F.min("elapsed_ms") > 0).alias("timed")))


@add("stream_funnel", f"""select event_date, {", ".join(f"cast(count(distinct if(event_type = '{k}', session_id, null)) as bigint) as {k}" for k in ("page_view", "product_view", "add_to_cart", "checkout_start", "purchase"))}
    from fe group by 1 having event_date + interval 1 day <= (select max(ts) from events) - interval 1 day""", "fe")
def _funnel(s: SparkSession, d: str) -> DataFrame:
    base = scratch(s)
    fact_events(s, d).select("event_type", "session_id", F.col("occurred_at").cast("timestamp").alias("occurred_at")).write.parquet(
        f"{base}/in",
    )
    raw = s.readStream.schema("event_type string, session_id string, occurred_at timestamp").parquet(f"{base}/in")
    stream.stream_funnel(raw).writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(
        availableNow=True,
    ).start(f"{base}/out").awaitTermination()
    return s.read.parquet(f"{base}/out")


# --- order batches -----------------------------------------------------------------------------------------------------------


def shop(s: SparkSession, d: str, stored: bool = False) -> dict[str, DataFrame]:
    """Requests from the orders (``stored``: as a table, for those who read them more than once), and what they are
    checked against."""
    fo = fact_orders(s, d)
    item = F.struct("product_key", F.least(F.col("quantity"), F.lit(10)).alias("quantity"))
    requests = (
        fo.groupBy(F.col("order_id").alias("request_id"), "customer_key", F.col("ordered_at").alias("at"))
        .agg(F.collect_list(item).alias("items"), F.max("discount_code").alias("discount_code"))
        .withColumn("shipping_cents", (F.col("request_id") % 5 * 100).cast("bigint"))
    )
    requests = save(requests, "requests") if stored else requests
    dp, n = dim_products(s, d), F.col("n")
    products = dp.select(
        "product_key",
        "base_price_cents",
        F.when(F.col("product_key") % 4 == 0, F.expr("base_price_cents * 90 div 100")).alias("sale_price_cents"),
        (F.col("product_key") % 50 != 0).alias("is_active"),
    )
    codes = requests.select("discount_code").where("discount_code is not null").distinct()
    codes = codes.withColumn("n", F.substring("discount_code", 5, 3).cast("int"))
    codes = codes.select(
        F.col("discount_code").alias("code"),
        F.element_at(F.array(F.lit("percentage"), F.lit("fixed_amount"), F.lit("free_shipping")), n % 3 + 1).alias("discount_type"),
        n.cast("double").alias("discount_value"),
        (n * 20_000).cast("bigint").alias("minimum_cents"),
        F.when(n == 9, 50).cast("bigint").alias("maximum_uses"),
        F.lit(0).cast("bigint").alias("current_uses"),
        (n != 7).alias("is_active"),
        F.lit("1990-01-01").cast("timestamp_ntz").alias("valid_from"),
        F.when(n == 8, F.lit("2000-01-01")).cast("timestamp_ntz").alias("valid_until"),
    )
    stock = (
        inventory(s, d)
        .select("product_key", (F.col("quantity_on_hand") - F.col("quantity_reserved")).alias("quantity_available"))
        .where("product_key % 97 <> 0")
    )
    customers = dim_customers(s, d).select(
        "customer_key",
        (F.col("customer_key") % 40 != 0).alias("is_active"),
        (F.col("customer_key") % 100).alias("loyalty_points"),
    )
    return {"requests": requests, "products": products, "codes": codes, "inventory": stock, "customers": customers}


def discounted(s: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The shop, with its requests and what their items came to stored, and the discounts of the requests."""
    x = shop(s, d, stored=True)
    x["items"] = orders.request_items(x["requests"])
    x["assessed"] = save(orders.assess_items(x["items"], x["products"], x["inventory"]), "assessed")
    first = orders.price_orders(x["requests"], x["products"], assessed=x["assessed"]).select("request_id", "subtotal_cents", "shipping_cents")
    return x, orders.apply_discounts(first.join(x["requests"].select("request_id", "at", "discount_code"), "request_id"), x["codes"])


def _priced(x: dict[str, DataFrame], found: DataFrame) -> DataFrame:
    return orders.price_orders(x["requests"], x["products"], found.select("request_id", "discount_cents"), assessed=x["assessed"])


def _rejected(x: dict[str, DataFrame], found: DataFrame) -> DataFrame:
    return orders.order_rejections(x["requests"], x["customers"], x["products"], x["inventory"], found, x["assessed"])


_SHOP = """with i as (select order_id as request_id, customer_key, ordered_at as tm, product_key, least(quantity, 10) as quantity,
  discount_code from fo), pr as (select product_key, case when product_key % 4 = 0 then base_price_cents * 90 // 100
  else base_price_cents end as price from dp),
q as (select request_id, customer_key, tm, max(discount_code) as code, cast(request_id % 5 * 100 as bigint) as shipping_cents,
  cast(sum(quantity * price) as bigint) as subtotal_cents from i join pr using (product_key) group by 1, 2, 3),
v as (select *, cast(substring(code, 5) as int) as n from q), ok as (select *, n <> 7
  and (n <> 8 or tm < timestamp '2000-01-01') as valid, subtotal_cents >= n * 20000 as enough from v),
tu as (select *, sum(case when valid and enough then 1 else 0 end) over (partition by code
  order by tm, request_id rows unbounded preceding) as turn from ok),
re as (select *, case when code is null then null when not valid then 'P0006' when not enough then 'P0007' when n = 9 and turn > 50
  then 'P0008' end as reason from tu),
di as (select *, cast(case when code is null or reason is not null then 0 when n % 3 = 0 then floor(subtotal_cents * n / 100.0 + 0.5)
  when n % 3 = 1 then least(n * 100, subtotal_cents) else shipping_cents end as bigint) as discount_cents from re)"""
add("apply_discounts", f"{_SHOP} select request_id, discount_cents, reason from di", "fo dp")(lambda s, d: discounted(s, d)[1])
add(
    "price_orders",
    f"{_SHOP}, t as (select *, cast(floor((subtotal_cents - discount_cents) * 0.08 + 0.5) as bigint) as tax_cents from di) "
    f"select request_id, customer_key, shipping_cents, subtotal_cents, discount_cents, tax_cents, subtotal_cents - discount_cents + "
    f"shipping_cents + tax_cents as total_cents from t",
    "fo dp",
)(lambda s, d: _priced(*discounted(s, d)))
_REJECTED = """, st as (select product_key, quantity_on_hand - quantity_reserved as available from inv
  where product_key % 97 <> 0), ck as (select request_id, bool_or(available is null) as f3, bool_or(product_key % 50 = 0) as f4,
  bool_or(available < quantity) as f5 from i left join st using (product_key) group by 1),
rj as (select request_id, case when customer_key % 40 = 0 then 'P0001' when f3 then 'P0003' when f4 then 'P0004' when f5 then 'P0005'
  else reason end as rejected from di join ck using (request_id))"""
add("order_rejections", f"{_SHOP}{_REJECTED} select * from rj where rejected is not null", "fo dp inv")(
    lambda s, d: _rejected(*discounted(s, d)),
)


@add("reserve_stock", f"""{_SHOP}{_REJECTED}, a as (select request_id, product_key, cast(sum(quantity) as bigint) as quantity, tm from i
  where request_id not in (select request_id from rj where rejected is not null) group by 1, 2, 4), w as (select *, cast(sum(quantity)
  over (partition by product_key order by tm, request_id rows unbounded preceding) as bigint) as asked from a)
select request_id, product_key, quantity, asked, coalesce(available, 0) as available, asked <= coalesce(available, 0) as reserved from w
  left join st using (product_key)""", "fo dp inv")
def _reserved(s: SparkSession, d: str) -> DataFrame:
    x, found = discounted(s, d)
    items = (
        x["items"]
        .join(_rejected(x, found), "request_id", "left_anti")
        .groupBy("request_id", "product_key", "at")
        .agg(F.sum("quantity").alias("quantity"))
    )
    return orders.reserve_stock(items, x["inventory"])


add(
    "loyalty_points",
    "select customer_key, cast(customer_key % 100 + coalesce(sum(total_cents // 100), 0) as bigint) as loyalty_points from dc left "
    "join oh using (customer_key) group by 1",
    "oh dc",
)(lambda s, d: orders.loyalty_points(order_heads(s, d), shop(s, d)["customers"]))
add(
    "order_numbers",
    "select order_id, 'ORD-' || year(created_at) || '-' || lpad(cast(999 + row_number() "
    "over (order by order_id) as varchar), 8, '0') as order_number from oh",
    "oh",
)(lambda s, d: orders.order_numbers(order_heads(s, d).select("order_id", "created_at")))


@add("status_updates", """with u as (select l_orderkey as order_id, l_shipdate + to_hours(l_linenumber) as tm, case l_linenumber % 4 when 0
  then 'shipped' when 1 then 'delivered' when 2 then 'lost' else 'processing' end as st from lineitem), w as (select * from u
  where st <> 'lost')
select oh.order_id, coalesce(arg_max(st, row(tm, st)), any_value(status)) as status, min(tm) filter (st = 'shipped') as shipped_at, min(tm)
  filter (st = 'delivered') as delivered_at from oh left join w using (order_id) group by 1""", "oh")
def _updates(s: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber") % 4
    updates = read(s, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_shipdate") + F.make_interval(hours=F.col("l_linenumber"))).alias("at"),
        F.when(n == 0, "Shipped").when(n == 1, "delivered").when(n == 2, "lost").otherwise("processing").alias("status"),
    )
    return orders.status_updates(order_heads(s, d).select("order_id", "status"), updates)


@add(
    "upsert_entities",
    "select customer_key, case when customer_key % 3 = 0 then concat('new', cast(customer_key as varchar)) else email end as email, "
    "case when customer_key % 5 = 0 then 'Moved' else city end as city, customer_key % 7 <> 0 as is_active from dc",
    "dc",
)
def _upserted(s: SparkSession, d: str) -> DataFrame:
    dc = dim_customers(s, d).select("customer_key", "email", "city", F.lit(True).alias("is_active"))
    key = F.col("customer_key")
    changes = dc.select(
        "customer_key",
        F.when(key % 3 == 0, F.concat(F.lit("new"), key.cast("string"))).alias("email"),
        F.when(key % 5 == 0, "Moved").alias("city"),
        F.when(key % 7 == 0, F.lit(False)).alias("is_active"),
        F.lit(1).alias("at"),
    )
    old = changes.withColumn("at", F.lit(0)).withColumn("city", F.lit("Old"))
    return orders.upsert_entities(dc, changes.unionByName(old), "customer_key", "email", ["email", "city", "is_active"], ["email"])[0]


# --- retention ---------------------------------------------------------------------------------------------------------------

add(
    "partition_inventory",
    "select strftime(created_at, '%Y') as year, strftime(created_at, '%m') as month, cast(count(*) as bigint) as row_count, "
    "min(created_at) as first_at, max(created_at) as last_at from oh group by 1, 2",
    "oh",
)(lambda s, d: lake.partition_inventory(order_heads(s, d), "created_at"))
add(
    "partition_gaps",
    "select cast(x as date) as part from generate_series(timestamp '1994-06-01', timestamp '2002-03-01', interval 1 month) t(x) "
    "where date_trunc('month', x) not in (select date_trunc('month', o_orderdate) from orders)",
)(lambda s, d: lake.partition_gaps(read(s, d, "orders"), "o_orderdate", "1994-06-01", "2002-03-01"))
add(
    "expired_partitions",
    "select cast(date_trunc('month', o_orderdate) as date) as part, cast(count(*) as bigint) as row_count from orders group by 1 "
    "having date_trunc('month', any_value(o_orderdate)) + interval 1 month <= (select max(o_orderdate)::date "
    "from orders) - interval 24 month",
)(lambda s, d: lake.expired_partitions(read(s, d, "orders"), "o_orderdate", 24))
@add("archive_old", """select 'orders_' || strftime(o_orderdate, '%Y_%m') as partition_name, cast(count(*) as bigint) as row_count, case
  when max(o_orderdate) < timestamp '1999-08-01' then 'archived' else 'kept' end as state from orders group by 1""")
def _archived(s: SparkSession, d: str) -> DataFrame:
    base = scratch(s)
    lake.write_lake(read(s, d, "orders").select("o_orderkey", "o_orderdate"), base, "orders", "o_orderdate")
    lake.archive_old(s, base, "orders", f"{base}/archive", "2001-08-01")
    log = s.read.parquet(f"{base}/archive/log").select("partition_name", "row_count", F.lit("archived").alias("state"))
    kept = (
        lake.read_lake(s, base, "orders")
        .groupBy(F.concat_ws("_", F.lit("orders"), "year", "month").alias("partition_name"))
        .agg(big(F.count(F.lit(1))).alias("row_count"))
    )
    return log.unionByName(kept.withColumn("state", F.lit("kept")))


@add("register_partitions", "select cast(count(*) as bigint) as n from oh", "oh")
def _registered(s: SparkSession, d: str) -> DataFrame:
    base, written = _lake(s, d)
    name = f"lake_{uuid.uuid4().hex}"
    s.sql(
        f"CREATE TABLE {name} (order_id bigint, customer_key bigint, created_at timestamp_ntz, status string, total_cents bigint, "
        f"year string, month string, day string) USING parquet PARTITIONED BY (year, month, day) LOCATION '{base}/orders'",
    )
    parts = [tuple(r) for r in written.select("year", "month", "day").distinct().collect()]
    lake.register_partitions(s, name, f"{base}/orders", parts)
    lake.register_partitions(s, name, f"{base}/orders", parts)
    return s.table(name).agg(big(F.count(F.lit(1))).alias("n"))


@add(
    "maintenance_log",
    "select 'orders' as table_name, strftime(date_trunc('month', o_orderdate), '%Y-%m') as partition_name, 'expired' as action "
    "from orders group by 2 having max(o_orderdate) < timestamp '1996-01-01'",
)
def _maintenance(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    old = lake.expired_partitions(read(s, d, "orders"), "o_orderdate", 0, "1996-01-01").collect()
    lake.log_rows(s, path, [("orders", f"{r['part']:%Y-%m}", "expired") for r in old], lake.MAINTENANCE_LOG)
    return s.read.parquet(path).drop("logged_at")


_MARTS = ("daily_sales", "product_performance", "customer_cohorts", "funnel_daily")


@add(
    "refresh_marts",
    " union all ".join(
        f"select '{n}' as mart, cast((select count(*) from ({ANALYTICS_SQL[n]})) as bigint) as row_count, 'SUCCESS' as status"
        for n in _MARTS
    ) + " union all select 'broken', null, 'ERROR'",
)
def _refreshed(s: SparkSession, d: str) -> DataFrame:
    from tradewind.plans.pipeline import refresh_marts

    marts = {name: (lambda n=name: ANALYTICS[n](s, d)) for name in _MARTS}
    marts["broken"] = lambda: s.sql("select raise_error('no such mart')").cache()
    return refresh_marts(s, marts, scratch(s), "1").select("mart", "row_count", "status")


__all__ = ["TIER", "snapshots"]
