"""Customer analytics: lifetime value, recency-frequency-money, cohorts, churn, recommendations.

``fo``: fact_orders (one row per item), ``dc`` / ``dp``: current customers / products. ``as_of=None``: the newest order day.
Segment names and cut-offs are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.columns import NOT_SOLD, big, money, month, months_between_starts, n_distinct, n_where, ratio, rounded, sold, with_as_of, with_first
from tradewind.functions.ranks import ROWS_PER_RANGE, approximate_positions, carried, global_positions, percent_rank, tile
from tradewind.functions.store import save


def customer_ltv(fo: DataFrame, dc: DataFrame, approx: bool = False) -> DataFrame:
    """Per customer: orders, revenue, dates, and the place of the revenue among all customers (``approx``: by a sketch)."""
    per = sold(fo).groupBy("customer_key").agg(
        n_distinct("order_id").alias("order_count"),
        F.sum("total_cents").alias("cents"),
        F.avg("total_cents").alias("mean_cents"),
        F.stddev("total_cents").alias("spread_cents"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    per = per.join(dc.select("customer_key", "email", "loyalty_tier", "acquisition_source"), "customer_key")
    positions = approximate_positions if approx else global_positions
    per = positions(per, {"rev": ("cents", False)}, "customer_key", ranked=("rev",)).withColumn("decile", tile("rev", 10))
    return per.select(
        "customer_key", "email", "loyalty_tier", "acquisition_source", "order_count",
        money(F.col("cents")).alias("lifetime_revenue"),
        money(F.col("mean_cents")).alias("avg_order_value"),
        money(F.col("spread_cents")).alias("stddev_order_value"),
        "first_order_date", "last_order_date",
        big(F.datediff("last_order_date", "first_order_date")).alias("tenure_days"),
        F.col("decile").alias("revenue_decile"),
        tile("rev", 4).alias("revenue_quartile"),
        rounded(percent_rank("rev") * 100.0, 1).alias("revenue_percentile_rank"),
        F.when(F.col("decile") == 10, "Top 10%").when(F.col("decile") >= 8, "Top 30%").when(F.col("decile") >= 6, "Mid Tier").otherwise("Low Tier").alias("customer_value_segment"),
    )


def _recency(fo: DataFrame, as_of: str | None, months: int | None, without: tuple[str, ...] = ("cancelled",)) -> DataFrame:
    df = with_as_of(fo, as_of, "order_date")
    df = sold(df, without)
    if months is not None:
        df = df.where(F.col("order_date") >= F.add_months("as_of", -months))
    return df.groupBy("customer_key").agg(
        big(F.datediff(F.max("as_of"), F.max("order_date"))).alias("recency"),
        n_distinct("order_id").alias("frequency"),
        F.sum("total_cents").alias("cents"),
    )


def rfm_scores(fo: DataFrame, as_of: str | None = None, months: int = 12, direction: str = "literal", approx: bool = False) -> DataFrame:
    """Per customer: scores 1 to 5 and the segment. ``literal``: as in the blueprint, frequency and money score 1 for the
    best; ``corrected``: 5 for the best. ``approx``: cut points from sketches; customers with equal values score alike."""
    best_first = direction == "literal"
    df = (approximate_positions if approx else global_positions)(
        _recency(fo, as_of, months),
        {"r": ("recency", False), "f": ("frequency", best_first), "m": ("cents", best_first)},
        "customer_key",
    )
    df = df.select(
        "customer_key",
        "recency",
        "frequency",
        "cents",
        (F.lit(6) - tile("r", 5)).cast("bigint").alias("r_score"),
        tile("f", 5).alias("f_score"),
        tile("m", 5).alias("m_score"),
    )
    return df.withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score")).withColumn(
        "rfm_segment",
        _segment(F.col("r_score"), F.col("f_score")),
    )


#: Fixed values: (condition on recency score r and frequency score f, segment), the first that holds.
SEGMENTS = [
    (lambda r, f: (r >= 4) & (f >= 4), "Champions"),
    (lambda r, f: (r >= 4) & (f >= 2), "Loyal Customers"),
    (lambda r, f: (r >= 3) & (f >= 3), "Potential Loyalists"),
    (lambda r, f: (r == 5) & (f == 1), "New Customers"),
    (lambda r, f: (r >= 4) & (f == 1), "Promising"),
    (lambda r, f: (r == 3) & (f >= 3), "Need Attention"),
    (lambda r, f: (r <= 2) & (f >= 4), "At Risk"),
    (lambda r, f: (r <= 2) & (f >= 2), "About to Sleep"),
    (lambda r, f: (r == 1) & (f == 1), "Lost"),
]


def _segment(r: Column, f: Column) -> Column:
    return F.coalesce(*[F.when(holds(r, f), name) for holds, name in SEGMENTS], F.lit("Others"))


def rfm_segments(fo: DataFrame, as_of: str | None = None, months: int = 12, direction: str = "literal") -> DataFrame:
    """Customers, averages and share by segment."""
    by = (
        rfm_scores(fo, as_of, months, direction)
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.avg("recency").alias("r"),
            F.avg("frequency").alias("f"),
            F.avg("cents").alias("m"),
            F.sum("cents").alias("s"),
        )
    )
    every = F.sum("customer_count").over(Window.partitionBy())
    return by.select(
        "rfm_segment",
        big(F.col("customer_count")).alias("customer_count"),
        rounded(F.col("r")).alias("avg_recency_days"),
        rounded(F.col("f"), 1).alias("avg_frequency"),
        money(F.col("m")).alias("avg_monetary"),
        money(F.col("s")).alias("total_revenue"),
        ratio(F.col("customer_count"), every, 1).alias("pct_of_customers"),
    )


def rfm_mart(fo: DataFrame, as_of: str | None = None, months: int = 12, now: str | None = None) -> DataFrame:
    """Stored scores per customer; ``now``: the time of the run, as ``calculated_at``."""
    df = rfm_scores(fo, as_of, months)
    df = df.select(
        "customer_key",
        F.col("recency").alias("recency_days"),
        "frequency",
        F.col("cents").alias("monetary_cents"),
        "r_score",
        "f_score",
        "m_score",
        "rfm_total",
        "rfm_segment",
    )
    return df if now is None else df.withColumn("calculated_at", F.lit(now).cast("timestamp"))


def rfm_report(fo: DataFrame, as_of: str | None = None) -> DataFrame:
    """All-time scores where 5 is best, in six segments."""
    df = global_positions(
        _recency(fo, as_of, None, NOT_SOLD),
        {"r": ("recency", True), "f": ("frequency", False), "m": ("cents", False)},
        "customer_key",
    )
    r, f, m = (tile(x, 5) for x in "rfm")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r == 1) & (f <= 2), "Lost")
        .otherwise("Potential Loyalists")
    )
    by = (
        df.withColumn("segment", segment)
        .groupBy("segment")
        .agg(
            big(F.count(F.lit(1))).alias("customer_count"),
            F.avg("recency").alias("r"),
            F.avg("frequency").alias("f"),
            F.avg("cents").alias("m"),
        )
    )
    return by.select(
        "segment",
        "customer_count",
        rounded(F.col("r"), 1).alias("avg_recency_days"),
        rounded(F.col("f"), 2).alias("avg_orders"),
        money(F.col("m")).alias("avg_ltv"),
    )


def _activity(fo: DataFrame, without: tuple[str, ...] = ("cancelled",)) -> DataFrame:
    """Months in which each customer bought, with the first of them: one shuffle by customer."""
    months = sold(fo, without).select("customer_key", month(F.col("order_date")).alias("active")).distinct()
    return months.withColumn("cohort", F.min("active").over(Window.partitionBy("customer_key"))).withColumn(
        "age",
        months_between_starts(F.col("active"), F.col("cohort")),
    )


def cohort_retention(fo: DataFrame, as_of: str | None = None, cohort_months: int = 12, max_age: int = 6) -> DataFrame:
    """Customers of each monthly cohort that bought again 0 to ``max_age`` months on."""
    by = _activity(fo).groupBy("cohort", "age").agg(big(F.count(F.lit(1))).alias("retained_customers"))
    # In month 0 every member of a cohort buys.
    by = by.withColumn("size", F.max(F.when(F.col("age") == 0, F.col("retained_customers"))).over(Window.partitionBy("cohort")))
    by = by.withColumn("as_of", F.lit(as_of).cast("date")) if as_of else by.crossJoin(
        F.broadcast(fo.agg(F.max("order_date").alias("as_of"))),
    )
    by = by.where((F.col("cohort") >= F.add_months(month(F.col("as_of")), -cohort_months)) & (F.col("age") <= max_age))
    return by.select(
        F.col("cohort").alias("cohort_month"),
        F.col("size").alias("cohort_customers"),
        F.col("age").alias("months_since_cohort"),
        "retained_customers",
        ratio(F.col("retained_customers"), F.col("size"), 1).alias("retention_rate_pct"),
    )


def customer_cohorts(fo: DataFrame) -> DataFrame:
    """All cohorts and periods; size is the first period's."""
    paid = fo.where(F.col("payment_status").isin("captured", "partially_refunded"))
    by = _activity(paid).groupBy("cohort", "age").agg(big(F.count(F.lit(1))).alias("active_customers"))
    first = F.first("active_customers").over(Window.partitionBy("cohort").orderBy("age"))
    return by.select(
        F.col("cohort").alias("cohort_month"),
        F.col("age").alias("period_number"),
        "active_customers",
        first.alias("cohort_size"),
        ratio(F.col("active_customers"), first, 2).alias("retention_rate_pct"),
    )


def cohort_pivot(fo: DataFrame, literal: bool = False, n: int = 12) -> DataFrame:
    """Cohort size and return shares after 1, 2, 3 and 6 months; the latest ``n`` cohorts. ``literal``: ages are
    differences of yyyymm numbers, so ages across a year's end drop out."""
    df = _activity(fo, NOT_SOLD)
    ym = lambda d: F.year(d) * 100 + F.month(d)
    df = (
        df.withColumn("ym", big(ym(F.col("cohort"))))
        .withColumn("at", big(ym(F.col("active")) - ym(F.col("cohort"))) if literal else F.col("age"))
        .where("at between 0 and 6")
    )
    by = (
        df.groupBy("ym", "at")
        .agg(F.count(F.lit(1)).alias("active"))
        .groupBy("ym")
        .agg(*[F.max(F.when(F.col("at") == k, F.col("active"))).alias(f"a{k}") for k in (0, 1, 2, 3, 6)])
    )
    return (
        by.select(
            F.col("ym").alias("cohort_ym"),
            big(F.col("a0")).alias("cohort_size"),
            *[ratio(F.col(f"a{k}"), F.col("a0"), 1).alias(f"m{k}_pct") for k in (1, 2, 3, 6)],
        )
        .orderBy(F.desc("cohort_ym"))
        .limit(n)
    )


def churn_features(dc: DataFrame, fo: DataFrame, as_of: str | None = None, churn_days: int = 90) -> DataFrame:
    """Per current customer, also those who never bought: cadence, shares and a risk score (null without orders)."""
    # By order first, which the facts are dealt by: then orders are counted, not kept distinct.
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    order = sold(fo).groupBy("order_id", "customer_key").agg(
        F.sum("total_cents").alias("cents"),
        F.count("total_cents").alias("n"),
        F.max("order_date").alias("last"),
        F.min("order_date").alias("first"),
        flag(F.col("order_status") == "refunded").alias("back"),
        flag(F.col("discount_code").isNotNull()).alias("cut"),
    )
    per = order.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("orders"),
        (F.sum("cents") / F.sum("n")).alias("mean"),
        F.max("last").alias("last"),
        F.min("first").alias("first"),
        *[F.sum(c).alias(c) for c in ("cents", "back", "cut")],
    )
    df = dc.join(per, "customer_key", "left")
    df = df.withColumn("as_of", F.lit(as_of).cast("date")) if as_of else df.crossJoin(
        F.broadcast(fo.agg(F.max("order_date").alias("as_of"))),
    )
    recency, orders = F.datediff("as_of", "last"), F.coalesce("orders", F.lit(0))
    df = df.select(
        "customer_key", "loyalty_tier", "acquisition_source", "country_code",
        big(F.datediff("as_of", "customer_since_date")).alias("account_age_days"),
        big(orders).alias("total_orders"),
        big(F.coalesce("cents", F.lit(0))).alias("total_revenue_cents"),
        rounded(F.coalesce("mean", F.lit(0.0)), 2).alias("avg_order_value_cents"),
        F.coalesce("last", "customer_since_date").alias("last_order_date"),
        big(recency).alias("recency_days"),
        F.coalesce(rounded(F.datediff("last", "first") / F.nullif((F.col("orders") - 1).cast("double"), F.lit(0.0)), 2), F.lit(0.0)).alias("avg_days_between_orders"),
        ratio(F.col("back"), F.col("orders"), 2).alias("return_rate_pct"),
        ratio(F.col("cut"), F.col("orders"), 2).alias("discount_usage_rate_pct"),
        F.when(recency > churn_days, 1).otherwise(0).cast("bigint").alias("is_churned"),
    )
    late = F.when(F.col("recency_days") > 60, 30.0).otherwise(F.col("recency_days") / 2.0)
    points = [(F.col("total_orders") <= 1, 20), (F.col("return_rate_pct") > 20, 10), (F.col("avg_order_value_cents") < 2000, 10)]
    return df.withColumn("churn_risk_score", rounded(late + sum((F.when(c, float(p)).otherwise(0.0) for c, p in points), F.lit(0.0))))


def ltv_deciles(fo: DataFrame, approx: bool = False) -> DataFrame:
    """Customers and revenue by decile of revenue, with the share from the top. ``approx``: cut points from a sketch."""
    per = sold(fo).groupBy("customer_key").agg(F.sum("total_cents").alias("cents"))
    by = (
        (approximate_positions if approx else global_positions)(per, {"rev": ("cents", False)}, "customer_key")
        .groupBy(tile("rev", 10).alias("decile"))
        .agg(F.count(F.lit(1)).alias("n"), *[getattr(F, f)("cents").alias(f) for f in ("min", "max", "avg", "sum")])
    )
    every, top = F.sum("sum").over(Window.partitionBy()), F.sum("sum").over(Window.orderBy(F.desc("decile")))
    return by.select(
        "decile",
        big(F.col("n")).alias("customer_count"),
        *[money(F.col(f)).alias(a) for f, a in (("min", "min_ltv"), ("max", "max_ltv"), ("avg", "avg_ltv"), ("sum", "total_revenue"))],
        ratio(F.col("sum"), every, 1).alias("pct_of_total_revenue"),
        ratio(top, every, 1).alias("cumulative_revenue_from_top"),
    )


def new_vs_returning(fo: DataFrame) -> DataFrame:
    """Monthly split; new: all rows at a customer's first timestamp."""
    order = sold(fo).groupBy("order_id", "customer_key", "ordered_at", "order_date").agg(F.sum("total_cents").alias("cents"))
    df = with_first(save(order, "orders"), "customer_key", F.col("ordered_at"))
    new = F.col("ordered_at") == F.col("first")
    cents = lambda when: F.sum(F.when(when, F.col("cents")))
    by = df.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month")).agg(
        cents(new).alias("n"),
        cents(~new).alias("r"),
        F.sum("cents").alias("t"),
        n_where(new).alias("new_orders"),
        n_where(~new).alias("returning_orders"),
        n_distinct("customer_key", new).alias("new_customers"),
    )
    return by.select(
        "year_month",
        money(F.col("n")).alias("new_customer_revenue"),
        money(F.col("r")).alias("returning_customer_revenue"),
        money(F.col("t")).alias("total_revenue"),
        "new_orders",
        "returning_orders",
        "new_customers",
        ratio(F.col("r"), F.col("t"), 1).alias("returning_revenue_pct"),
    )


def cross_sell(fo: DataFrame, dp: DataFrame, dc: DataFrame, k: int = 5, parts: int = 64) -> DataFrame:
    """The ``k`` products a customer has not bought, of categories they ordered from, with most buyers in their tier.

    Pre-aggregated: the buyers of a product in a tier do not depend on the customer, and only a tier's best products of
    a category can be recommended, so each customer meets as many of them as they have bought in the category, plus k.
    A tier's best are found in hash parts first, so no task ranks all products of a category.
    """
    item = fo.join(dp.select("product_key", "category_name"), "product_key")
    item = item.join(dc.select("customer_key", "loyalty_tier"), "customer_key")
    item = item.groupBy("customer_key", "loyalty_tier", "product_key", "category_name").agg(
        F.max(F.when(F.col("order_status") != "cancelled", 1).otherwise(0)).alias("live"),
    )
    item = save(item, "bought")
    group = ["loyalty_tier", "category_name"]
    bought = item.where("live = 1")
    active = bought.select("customer_key").distinct()
    had = item.groupBy("customer_key", *group).agg(F.sum("live").alias("had")).join(active, "customer_key", "left_semi")
    reach = save(had.select("customer_key", *group, (F.col("had") + k).cast("int").alias("reach")), "reach")
    most = reach.groupBy(*group).agg(F.max("reach").alias("most"))
    order = [F.desc("buyers"), "product_key"]
    sold_to = bought.groupBy(*group, "product_key").agg(big(F.count(F.lit(1))).alias("buyers")).join(most, group)
    part = sold_to.withColumn("part", F.pmod(F.xxhash64("product_key"), F.lit(parts)))
    for by in ([*group, "part"], group):
        part = part.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("place <= most")
    # Per tier and category a list as long as its farthest reach. Stored, so that the join deals out both sides anew and
    # Spark can broadcast the lists or split a tier with very many customers.
    best = part.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("place", "product_key", "buyers"))).alias("best"))
    near = reach.join(save(best, "best"), group).select(
        "customer_key",
        "category_name",
        F.explode(F.slice("best", 1, F.col("reach"))).alias("p"),
    )
    offered = near.select("customer_key", "category_name", "p.product_key", "p.buyers")
    offered = offered.join(bought.select("customer_key", "product_key"), ["customer_key", "product_key"], "left_anti")
    out = offered.withColumn("recommendation_rank", big(F.row_number().over(Window.partitionBy("customer_key").orderBy(*order)))).where(
        F.col("recommendation_rank") <= k,
    )
    return out.select(
        "customer_key",
        "product_key",
        "category_name",
        F.col("buyers").alias("similar_customers_bought"),
        "recommendation_rank",
    )


def customer_360(
    dc: DataFrame,
    oh: DataFrame,
    fe: DataFrame,
    reviews: DataFrame,
    as_of: str | None = None,
    as_of_events: str | None = None,
    deleted: str = "deleted_at",
) -> DataFrame:
    """Per customer who is not deleted: paid orders, 90 days of events, published reviews, engagement and value segment.

    ``reviews``: customer_key, status, rating. ``dc`` may lack the column ``deleted``: then nobody is.
    """
    live = dc.where(F.col(deleted).isNull()) if deleted in dc.columns else dc
    paid = oh.where(F.col("payment_status").isin("captured", "partially_refunded", "refunded"))
    in_state = lambda s: F.count(F.when(F.col("status") == s, 1))
    orders = paid.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_cents").alias("cents"), F.avg("total_cents").alias("mean"),
        F.min("created_at").alias("first_order_at"), F.max("created_at").alias("last_order_at"),
        in_state("cancelled").alias("cancelled"), in_state("refunded").alias("refunded"), F.count_distinct(F.trunc("created_at", "month")).alias("months"),
    )
    kinds = ("page_view", "product_view", "add_to_cart", "search")
    seen = with_as_of(fe, as_of_events, "occurred_at").where(F.datediff("as_of", "event_date") < 90)
    seen = seen.groupBy("customer_key").agg(
        *[F.count(F.when(F.col("event_type") == t, 1)).alias(t) for t in kinds],
        F.max("occurred_at").alias("last_event_at"),
    )
    rated = (
        reviews.where("status = 'published'")
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("reviews"), F.avg("rating").alias("rating"))
    )
    day = oh.agg(F.max("created_at").cast("date").alias("as_of")) if as_of is None else None
    df = live.join(orders, "customer_key", "left").join(seen, "customer_key", "left").join(rated, "customer_key", "left")
    df = df.crossJoin(F.broadcast(day)) if day is not None else df.withColumn("as_of", F.lit(as_of).cast("date"))
    age, cents = F.datediff("as_of", F.col("last_order_at").cast("date")), F.col("cents")
    zero = lambda c: big(F.coalesce(c, F.lit(0)))
    return df.select(
        "customer_key", "customer_name", "email", "country_code", "city", "loyalty_tier",
        zero("orders").alias("total_orders"), zero("cents").alias("lifetime_revenue_cents"), rounded(F.coalesce("mean", F.lit(0.0))).alias("avg_order_value_cents"),
        "first_order_at", "last_order_at", zero("cancelled").alias("cancelled_orders"), zero("refunded").alias("refunded_orders"), zero("months").alias("active_months"),
        big(age).alias("days_since_last_order"),
        zero("page_view").alias("page_views_90d"), zero("product_view").alias("product_views_90d"), zero("add_to_cart").alias("cart_adds_90d"),
        zero("search").alias("searches_90d"), "last_event_at", zero("reviews").alias("total_reviews"), rounded(F.col("rating"), 2).alias("avg_rating_given"),
        F.when(age < 30, "active").when(age < 90, "at_risk").when(age < 180, "lapsing").when(age.isNotNull(), "churned").otherwise("never_purchased").alias("engagement_segment"),
        F.when(cents >= 100_000, "high_value").when(cents >= 50_000, "mid_value").when(cents > 0, "low_value").otherwise("no_purchases").alias("value_segment"),
    )


def customer_value(dc: DataFrame, oh: DataFrame) -> DataFrame:
    """Orders and value per active customer, zero without any."""
    per = (
        oh.where(~F.col("status").isin(*NOT_SOLD))
        .groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("total_cents").alias("cents"),
            F.min("created_at").alias("first_order_at"),
            F.max("created_at").alias("last_order_at"),
        )
    )
    return (
        dc.where("is_current")
        .join(per, "customer_key", "left")
        .select(
            "customer_key",
            "email",
            "customer_name",
            big(F.coalesce("n", F.lit(0))).alias("total_orders"),
            big(F.coalesce("cents", F.lit(0))).alias("lifetime_value_cents"),
            "first_order_at",
            "last_order_at",
        )
    )


def ltv_projection(oh: DataFrame, dc: DataFrame, as_of: str | None = None, customer_key: int | None = None) -> DataFrame:
    """Twelve months ahead: mean order value times orders per month of tenure (whole months, at least 1) times 12."""
    df = with_as_of(oh, as_of, "created_at")
    df = df.where(~F.col("status").isin("cancelled") & F.col("payment_status").isin("captured", "partially_refunded"))
    if customer_key is not None:
        df = df.where(F.col("customer_key") == customer_key)
    per = df.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("created_at").cast("date").alias("first_order_date"),
        F.max("created_at").cast("date").alias("last_order_date"),
        F.sum("total_cents").alias("cents"),
        F.max("as_of").alias("as_of"),
    )
    months = months_between_starts(F.col("as_of"), F.col("first_order_date")) - F.when(
        F.dayofmonth("as_of") < F.dayofmonth("first_order_date"),
        1,
    ).otherwise(0)
    per = per.withColumn("tenure_months", F.greatest(F.lit(1), months).cast("bigint")).withColumn(
        "predicted_ltv_12m_cents",
        F.floor(F.col("cents").cast("double") / F.col("tenure_months") * 12 + 0.5).cast("bigint"),
    )
    ahead = F.col("predicted_ltv_12m_cents")
    return per.join(dc.select("customer_key", "email"), "customer_key").select(
        "customer_key", "email", "first_order_date", "last_order_date", big(F.col("n")).alias("order_count"), F.col("cents").alias("total_revenue_cents"),
        rounded(F.col("cents") / F.col("n"), 2).alias("avg_order_value_cents"), rounded(F.col("n") / F.col("tenure_months"), 4).alias("orders_per_month"), "tenure_months", "predicted_ltv_12m_cents",
        F.when(ahead >= 100_000, "platinum").when(ahead >= 50_000, "gold").when(ahead >= 20_000, "silver").otherwise("bronze").alias("ltv_tier"),
    )


#: Flags of the fraud rules, their points, and the countries that are no risk.
FLAGS = {
    "velocity": "HIGH_VELOCITY: >5 orders in 24h",
    "address": "IP_VELOCITY: >3 orders from same IP in 1h",
    "value": "HIGH_VALUE: order > $500",
    "amount": "ANOMALOUS_AMOUNT: 3+ std deviations above customer average",
    "new": "NEW_CUSTOMER: no prior purchase history",
    "country": "HIGH_RISK_COUNTRY: non-standard shipping destination",
}
POINTS = {"velocity": 25, "address": 30, "value": 15, "amount": 25, "new": 10, "country": 15}
HOME = ("US", "CA", "GB", "AU")


def _lately(df: DataFrame, key: str, seconds: int, name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows of the same key in the last ``seconds`` up to each row: the rows so far at its time less those before the
    stretch began. Both are running counts along ranges, so a key with very many rows at one time is no task's alone."""
    df = save(df.withColumn("__row", F.monotonically_increasing_id()), "lately")
    mark = lambda at, kind: df.select(key, at.alias("at"), F.lit(kind).alias("kind"), "__row")
    # At one time: the begin of a stretch comes before the rows, the end of one after them.
    marks = mark(F.col("at"), 0).unionByName(mark(F.col("at") - seconds, -1)).unionByName(mark(F.col("at"), 1))
    found = carried(marks, [key], ["at", "kind"], sums={"so_far": F.when(F.col("kind") == 0, 1)}, rows_per_range=rows_per_range)
    counts = found.where("kind <> 0").groupBy("__row").agg(F.sum(F.col("so_far") * F.col("kind")).alias(name))
    return df.join(counts, "__row").drop("__row")


def fraud_flags(oh: DataFrame, as_of: str | None = None, hours: int = 24) -> DataFrame:
    """Flagged orders of the last ``hours``: counts per customer (24 h) and address (1 h) as range frames, history of
    the customer before the last 24 hours, score up to 100, recommendation from part of the points."""
    now = F.lit(as_of).cast("timestamp") if as_of else None
    df = oh.where(F.col("status") != "cancelled")
    df = df.withColumn("now", now) if now is not None else df.crossJoin(F.broadcast(oh.agg(F.max("created_at").alias("now"))))
    df = df.withColumn("at", F.unix_timestamp("created_at")).withColumn("ago", F.unix_timestamp("now") - F.col("at"))
    history = (
        df.where((F.col("ago") > 86400) & F.col("payment_status").isin("captured", "partially_refunded"))
        .groupBy("customer_key")
        .agg(F.avg("total_cents").alias("mean"), F.stddev("total_cents").alias("spread"), F.count(F.lit(1)).alias("before"))
    )
    recent = df.where(F.col("ago") < hours * 3600)
    recent = _lately(_lately(recent, "customer_key", 86400, "day"), "ip_address", 3600, "hour")
    df = recent.join(history, "customer_key", "left")
    rules = {
        "velocity": F.col("day") > 5,
        "address": F.col("hour") > 3,
        "value": F.col("total_cents") > 50_000,
        "amount": (F.col("spread") > 0) & (F.col("total_cents") > F.col("mean") + 3 * F.col("spread")),
        "new": F.coalesce("before", F.lit(0)) == 0,
        "country": ~F.col("shipping_country").isin(*HOME),
    }
    points = lambda *names: F.least(F.lit(100), sum((F.when(rules[n], POINTS[n]).otherwise(0) for n in names), F.lit(0)))
    flags = F.array_compact(F.array(*[F.when(rules[n], FLAGS[n]) for n in FLAGS]))
    advice = (
        F.when(points("velocity", "address", "value", "new") >= 70, "BLOCK")
        .when(points("velocity", "address", "value") >= 40, "REVIEW")
        .otherwise("ALLOW")
    )
    return (
        df.withColumn("flags", flags)
        .where(F.size("flags") > 0)
        .select(
            "order_id",
            "customer_key",
            "total_cents",
            big(points(*FLAGS)).alias("risk_score"),
            F.array_join("flags", "; ").alias("risk_flags"),
            advice.alias("recommendation"),
        )
    )
