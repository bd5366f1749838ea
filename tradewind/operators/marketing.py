"""Marketing analytics over events: attribution and funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.columns import big, money, n_distinct, ratio, rounded, sold, with_as_of

STEPS = ("page_view", "product_view", "add_to_cart", "checkout_start", "purchase")


def attribution(fe: DataFrame, fo: DataFrame, touch_types: tuple[str, ...] = ("page_view", "product_view")) -> DataFrame:
    """Revenue credit per source and medium: first touch, last touch, and equal shares rounded per touch. Customers
    without a tagged touch drop out. First and last come from aggregates, so a customer's touches are never sorted."""
    touch = fe.where(F.col("utm_source").isNotNull() & F.col("event_type").isin(*touch_types)).withColumn(
        "at",
        F.struct("occurred_at", "event_id"),
    )
    ends = touch.groupBy("customer_key").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("touches"))
    spent = sold(fo).groupBy("customer_key").agg(F.sum("total_cents").alias("cents"))
    per = ends.join(spent, "customer_key").withColumn("share", F.floor(F.col("cents") / F.col("touches") + 0.5).cast("bigint"))
    df = touch.join(per, "customer_key")
    credit = lambda end: F.sum(F.when(F.col("at") == F.col(end), F.col("cents")).otherwise(0))
    by = df.groupBy("utm_source", "utm_medium").agg(
        n_distinct("customer_key").alias("attributed_customers"),
        credit("first").alias("f"),
        credit("last").alias("l"),
        F.sum("share").alias("s"),
    )
    return by.select(
        "utm_source",
        "utm_medium",
        "attributed_customers",
        money(F.col("f")).alias("first_touch_revenue"),
        money(F.col("l")).alias("last_touch_revenue"),
        money(F.col("s")).alias("linear_revenue"),
        ratio(F.col("f") - F.col("l"), F.col("l"), 1).alias("first_vs_last_pct_diff"),
    )


def _daily(fe: DataFrame) -> DataFrame:
    """Distinct sessions per day and step. Sessions are first reduced to one row per day and step."""
    once = fe.where(F.col("event_type").isin(*STEPS)).select("event_date", "event_type", "session_id").distinct()
    return once.groupBy("event_date").agg(*[big(F.count(F.when(F.col("event_type") == s, 1))).alias(s) for s in STEPS])


def funnel_monthly(fe: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    """Monthly sums of daily distinct sessions per step, with step rates."""
    df = _daily(with_as_of(fe, as_of, "occurred_at").where(F.col("event_date") >= F.date_sub("as_of", days)))
    by = df.groupBy(F.date_format("event_date", "yyyy-MM").alias("year_month")).agg(*[F.sum(s).alias(s) for s in STEPS])
    view, product, cart, check, buy = (F.col(s) for s in STEPS)
    return by.select(
        "year_month",
        view.alias("total_sessions"),
        product.alias("total_product_views"),
        cart.alias("total_cart_adds"),
        check.alias("total_checkouts"),
        buy.alias("total_purchases"),
        ratio(product, view, 2).alias("session_to_pv_rate"),
        ratio(cart, product, 2).alias("pv_to_atc_rate"),
        ratio(check, cart, 2).alias("atc_to_checkout_rate"),
        ratio(buy, check, 2).alias("checkout_to_purchase_rate"),
        ratio(buy, view, 3).alias("overall_conversion_rate"),
        ratio(cart - buy, cart, 2).alias("cart_abandonment_rate"),
    )


def funnel_daily(fe: DataFrame) -> DataFrame:
    """Daily distinct sessions per step, with step rates."""
    view, product, cart, check, buy = (F.col(s) for s in STEPS)
    days = fe.select("event_date").distinct()
    df = days.join(_daily(fe), "event_date", "left").na.fill(0, list(STEPS))
    return df.select(
        "event_date",
        view.alias("sessions"),
        product.alias("product_views"),
        cart.alias("cart_adds"),
        check.alias("checkout_starts"),
        buy.alias("purchases"),
        ratio(product, view, 2).alias("pv_session_rate"),
        ratio(cart, product, 2).alias("atc_pv_rate"),
        ratio(check, cart, 2).alias("checkout_atc_rate"),
        ratio(buy, check, 2).alias("purchase_checkout_rate"),
        ratio(buy, view, 2).alias("overall_conversion_rate"),
    )


def funnel_steps(fe: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    """Distinct sessions of each step in order, with the step before and the share of the first (five rows)."""
    df = with_as_of(fe, as_of, "occurred_at").where((F.col("event_date") >= F.date_sub("as_of", days)) & F.col("event_type").isin(*STEPS))
    order = F.array_position(F.array(*[F.lit(s) for s in STEPS]), F.col("event_type"))
    by = df.groupBy("event_type").agg(n_distinct("session_id").alias("sessions")).withColumn("step", order)
    w = Window.orderBy("step")
    return by.select(
        "event_type",
        "sessions",
        F.lag("sessions").over(w).alias("prev_step_sessions"),
        rounded(F.col("sessions") * 100.0 / F.first("sessions").over(w), 1).alias("pct_of_top"),
    )


def stitch_identity(fe: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events whose customer is absent take the customer last known for their anonymous_id (``sessions``:
    anonymous_id, customer_key, started_at)."""
    known = (
        sessions.where("customer_key is not null")
        .groupBy("anonymous_id")
        .agg(F.max_by("customer_key", F.struct("started_at", "customer_key")).alias("known_customer"))
    )
    return (
        fe.join(known, "anonymous_id", "left")
        .withColumn("customer_key", F.coalesce("customer_key", "known_customer"))
        .drop("known_customer")
    )
