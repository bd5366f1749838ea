"""The star schema over the given tables: facts and dimensions as the operators expect them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS = """case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'cancelled'
 when l_returnflag = 'R' and o_orderpriority = '1-URGENT' then 'refunded' when o_orderstatus = 'F' then 'delivered' else 'pending' end"""
CENTS = {
    "unit_price_cents": "l_extendedprice / l_quantity",
    "discount_cents": "l_extendedprice * l_discount",
    "tax_cents": "l_extendedprice * (1 - l_discount) * l_tax",
    "total_cents": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
}
CODE = "case when l_discount >= 0.045 then concat('SAVE', cast(cast(floor(l_discount * 100 + 0.5) as int) as {text})) end"
METHOD = "case o_orderkey % 3 when 0 then 'credit_card' when 1 then 'paypal' else 'debit_card' end"
TIER = "case when c_acctbal < 1700 then 'bronze' when c_acctbal < 4300 then 'silver' when c_acctbal < 7300 then 'gold' else 'platinum' end"
EVENT = (
    "case event_type when 'view' then 'page_view' when 'click' then 'product_view' when 'signup' then 'add_to_cart' when 'error' "
    "then 'checkout_start' else event_type end"
)
SOURCE = "case when k < 25 then 'google' when k < 50 then 'facebook' when k < 75 then 'newsletter' end"
MEDIUM = "case when k < 25 then 'cpc' when k < 50 then 'social' when k < 75 then 'email' end"


def cents(expression: str) -> str:
    return f"cast(floor({expression} * 100 + 0.5) as bigint)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def newest_order(spark: SparkSession, sf_dir: str) -> str:
    """The day of the newest order: ``as_of`` of the order queries, as a literal that filters can use at the scan."""
    return read(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("date").cast("string")).first()[0]


def newest_event(spark: SparkSession, sf_dir: str) -> str:
    """The day of the newest event."""
    return read(spark, sf_dir, "events").agg(F.max("ts").cast("date").cast("string")).first()[0]


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order item. Nations are a dimension of fixed size. Orders meet customers first, so that the items,
    the largest table, are dealt out once."""
    item, order = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    home = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    placed = order.join(home, F.col("o_custkey") == F.col("c_custkey"))
    return item.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_partkey").alias("product_key"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.expr("o_orderdate + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 as int), 0, 0)").alias("ordered_at"),
        F.expr(STATUS).alias("order_status"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        *[F.expr(cents(e)).alias(c) for c, e in CENTS.items()],
        F.expr(CODE.format(text="string")).alias("discount_code"),
        F.expr(METHOD).alias("payment_method"),
        F.col("n_name").alias("shipping_country"),
    ).withColumn("payment_status", F.when(F.col("order_status") == "cancelled", "pending").otherwise("captured"))


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the sums of its items; cancelled or refunded where an item is."""
    fo = fact_orders(spark, sf_dir)
    any_of = lambda s: F.max((F.col("order_status") == s).cast("int")) == 1
    return (
        fo.groupBy("order_id", "customer_key", F.col("ordered_at").alias("created_at"), "payment_method", "shipping_country")
        .agg(
            F.when(any_of("cancelled"), "cancelled").when(any_of("refunded"), "refunded").when(any_of("delivered"), "delivered").otherwise(
                "pending",
            ).alias("status"),
            *[F.sum(c).alias(c) for c in ("discount_cents", "tax_cents", "total_cents", "quantity")],
        )
        .withColumn("payment_status", F.when(F.col("status") == "cancelled", "pending").otherwise("captured"))
        .withColumn("shipping_cents", (F.col("order_id") % 5 * 100).cast("bigint"))
    )


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return df.select(
        "event_id",
        F.col("ts").alias("occurred_at"),
        F.col("ts").cast("date").alias("event_date"),
        F.col("user_id").alias("customer_key"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("session_id"),
        F.expr(EVENT).alias("event_type"),
        (F.col("event_id") % 200).alias("product_key"),
        F.expr(SOURCE).alias("utm_source"),
        F.expr(MEDIUM).alias("utm_medium"),
        "props",
    )


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    df = customer.join(F.broadcast(place), customer.c_nationkey == nation.n_nationkey)
    return df.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country_code"),
        F.col("r_name").alias("state_province"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_mktsegment").alias("acquisition_source"),
        F.expr(TIER).alias("loyalty_tier"),
        F.col("c_acctbal").alias("balance"),
        F.expr("date_add(date '1995-01-01', cast(c_custkey % 365 as int))").alias("customer_since_date"),
        F.lit(True).alias("is_current"),
    )


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_name"),
        F.col("p_brand").alias("brand"),
        F.expr(cents("p_retailprice")).alias("base_price_cents"),
        F.col("p_size").alias("size"),
        F.lit(True).alias("is_current"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_hand = F.col("p_partkey") * 7 % 60
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lit("WH-"), (F.col("p_size") % 4).cast("string")).alias("warehouse_id"),
        on_hand.alias("quantity_on_hand"),
        F.least(F.col("p_partkey") % 5, on_hand).alias("quantity_reserved"),
        (F.col("p_size") % 20).cast("bigint").alias("reorder_point"),
        F.expr(f"{cents('p_retailprice')} * 60 div 100").alias("unit_cost_cents"),
    )


#: The same tables in DuckDB SQL, by name.
TABLES = {
    "fo": f"""select l_orderkey as order_id, o_custkey as customer_key, l_partkey as product_key, cast(o_orderdate as date) as order_date,
  o_orderdate + to_hours(o_orderkey % 24) as ordered_at, {STATUS} as order_status, cast(l_quantity as bigint) as quantity,
  {", ".join(f"{cents(e)} as {c}" for c, e in CENTS.items())}, {CODE.format(text="varchar")} as discount_code, {METHOD} as payment_method,
    n_name as shipping_country,
  case when {STATUS} = 'cancelled' then 'pending' else 'captured' end as payment_status
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "oh": """select *, case when status = 'cancelled' then 'pending' else 'captured' end as payment_status, cast(order_id % 5 * 100 as
  bigint) as shipping_cents from (
  select order_id, customer_key, ordered_at as created_at, payment_method, shipping_country,
  case when bool_or(order_status = 'cancelled') then 'cancelled' when bool_or(order_status = 'refunded') then 'refunded'
    when bool_or(order_status = 'delivered') then 'delivered' else 'pending' end as status,
  cast(sum(discount_cents) as bigint) as discount_cents, cast(sum(tax_cents) as bigint) as tax_cents, cast(sum(total_cents) as bigint) as
    total_cents, cast(sum(quantity) as bigint) as quantity
  from fo group by all)""",
    "fe": f"""select event_id, ts as occurred_at, cast(ts as date) as event_date, user_id as customer_key, concat(cast(user_id as varchar),
  '-', cast(cast(ts as date) as varchar)) as session_id,
  {EVENT} as event_type, event_id % 200 as product_key, {SOURCE} as utm_source, {MEDIUM} as utm_medium, props
    from (select *, cast(json_extract_string(props, '$.k') as int) as k from events)""",
    "dc": f"""select c_custkey as customer_key, c_name as customer_name, concat('c', cast(c_custkey as varchar), '@example.com') as email,
  n_name as country_code, r_name as state_province,
  c_mktsegment as city, c_mktsegment as acquisition_source, {TIER} as loyalty_tier, c_acctbal as balance, date '1995-01-01' + cast(c_custkey
    % 365 as int) as customer_since_date
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "dp": f"""select p_partkey as product_key, concat('SKU-', cast(p_partkey as varchar)) as sku, p_name as product_name, p_type as
  category_name, p_brand as brand,
  {cents("p_retailprice")} as base_price_cents, p_size as size from part""",
    "inv": f"""select p_partkey as product_key, concat('WH-', cast(p_size % 4 as varchar)) as warehouse_id, p_partkey * 7 % 60 as
  quantity_on_hand, least(p_partkey % 5, p_partkey * 7 % 60) as quantity_reserved,
  cast(p_size % 20 as bigint) as reorder_point, {cents("p_retailprice")} * 60 // 100 as unit_cost_cents from part""",
}


def with_tables(body: str, *names: str) -> str:
    """``body`` with the named tables in front; ``oh`` brings ``fo``."""
    names = ("fo", *names) if "oh" in names and "fo" not in names else names
    head = ", ".join(f"{n} as materialized ({TABLES[n]})" for n in TABLES if n in names)
    return f"with {head}, {body[5:]}" if body.lstrip().startswith("with ") else f"with {head} {body}"
