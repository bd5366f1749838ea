"""Revenue analytics: growth, seasons, regions, hours, discounts, forecast, dashboards.

Unpartitioned windows here run over days, weeks or months, whose number does not grow with the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.columns import NOT_SOLD, big, money, month, n_distinct, n_where, ratio, rounded, sold, with_as_of, with_first
from tradewind.functions.store import save


def revenue_growth(fo: DataFrame, as_of: str | None = None, days: int = 90, fill: bool = False) -> DataFrame:
    """Daily revenue with growth over one and seven rows, moving averages and the year so far. Rows, not calendar
    days, are counted; the year starts at its first day in the window. ``fill``: days without an order between the first
    and the last have rows of their own with no revenue, so rows are calendar days."""
    df = sold(with_as_of(fo, as_of, "order_date").where(F.col("order_date") >= F.date_sub("as_of", days)))
    order = df.groupBy("order_id", "customer_key", "order_date").agg(F.sum("total_cents").alias("rev"))
    by = order.groupBy("order_date").agg(
        F.sum("rev").alias("rev"),
        big(F.count(F.lit(1))).alias("order_count"),
        n_distinct("customer_key").alias("unique_customers"),
    )
    if fill:
        span = F.sequence(F.min("order_date"), F.max("order_date"))
        every = by.agg(span.alias("span")).select(F.explode("span").alias("order_date"))
        by = every.join(by, "order_date", "left").na.fill(0, ["rev", "order_count", "unique_customers"])
    w = Window.orderBy("order_date")
    rev, one, seven = F.col("rev"), F.lag("rev", 1).over(w), F.lag("rev", 7).over(w)
    return by.select(
        F.col("order_date").alias("full_date"), F.date_format("order_date", "EEEE").alias("day_name"), F.dayofweek("order_date").isin(1, 7).alias("is_weekend"), rev.alias("revenue_cents"), "order_count", "unique_customers",
        one.alias("prev_day_revenue"), ratio(rev - one, one, 1).alias("dod_growth_pct"), seven.alias("same_day_last_week"), ratio(rev - seven, seven, 1).alias("wow_growth_pct"),
        rounded(F.avg("rev").over(w.rowsBetween(-6, 0))).alias("ma7_revenue"), rounded(F.avg("rev").over(w.rowsBetween(-29, 0))).alias("ma30_revenue"),
        F.sum("rev").over(Window.partitionBy(F.year("order_date")).orderBy("order_date")).alias("ytd_revenue"),
    )


def geo_heatmap(fo: DataFrame, dc: DataFrame, as_of: str | None = None) -> DataFrame:
    """This and last calendar year by country, state and city, ranked within the country."""
    # Orders meet customers once, already summed per customer; orders and customers are then sums.
    df = sold(with_as_of(fo, as_of, "order_date"))
    now = F.year("order_date") == F.year("as_of")
    df = df.where(F.year("as_of") - F.year("order_date") <= 1).where(F.year("as_of") >= F.year("order_date"))
    per = df.groupBy("customer_key", "shipping_country").agg(
        F.sum(F.when(now, F.col("total_cents"))).alias("c"),
        F.sum(F.when(~now, F.col("total_cents"))).alias("p"),
        n_distinct("order_id", now).alias("o"),
    )
    by = (
        per.join(dc.select("customer_key", "state_province", "city"), "customer_key")
        .groupBy("shipping_country", "state_province", "city")
        .agg(F.sum("c").alias("c"), F.sum("p").alias("p"), F.sum("o").alias("o"), n_where(F.col("c").isNotNull()).alias("n"))
        .where("c is not null")
    )
    return by.select(
        "shipping_country",
        "state_province",
        "city",
        money(F.col("c")).alias("current_year_revenue"),
        money(F.col("p")).alias("prior_year_revenue"),
        F.col("o").alias("current_orders"),
        F.col("n").alias("current_customers"),
        ratio(F.col("c") - F.col("p"), F.col("p"), 1).alias("yoy_growth_pct"),
        big(F.rank().over(Window.partitionBy("shipping_country").orderBy(F.desc("c")))).alias("rank_in_country"),
    )


def seasonality(fo: DataFrame, as_of: str | None = None, months: int = 24) -> DataFrame:
    """Weekly revenue against centred means of 5 and 13 rows."""
    df = sold(with_as_of(fo, as_of, "order_date").where(F.col("order_date") >= F.add_months("as_of", -months)))
    by = df.groupBy(F.trunc("order_date", "week").alias("week_start")).agg(F.sum("total_cents").alias("rev"))
    w = Window.orderBy("week_start")
    short, long = F.avg("rev").over(w.rowsBetween(-2, 2)), F.avg("rev").over(w.rowsBetween(-6, 6))
    df = by.select(
        "week_start",
        F.col("rev").alias("weekly_revenue"),
        rounded(short).alias("trend_4_week"),
        rounded(long).alias("trend_12_week"),
        ratio(F.col("rev"), long, 1).alias("seasonality_index"),
    )
    x = F.col("seasonality_index")
    return df.withColumn(
        "season_classification",
        F.when(x > 115, "High Season").when(x > 105, "Above Average").when(x >= 95, "Normal").when(x >= 85, "Below Average").otherwise(
            "Low Season",
        ),
    )


def peak_hours(fo: DataFrame, as_of: str | None = None, days: int = 90) -> DataFrame:
    """Orders and revenue by hour: counts are sums of distinct orders per hour and day of week."""
    df = sold(with_as_of(fo, as_of, "order_date").where(F.col("order_date") >= F.date_sub("as_of", days)))
    by = df.groupBy(big(F.hour("ordered_at")).alias("hour_of_day"), F.dayofweek("order_date").alias("d")).agg(
        n_distinct("order_id").alias("n"),
        F.sum("total_cents").alias("c"),
        F.avg("total_cents").alias("m"),
    )
    end = F.col("d").isin(1, 7)
    out = by.groupBy("hour_of_day").agg(
        F.sum("n").alias("total_orders"),
        F.sum("c").alias("c"),
        F.avg("m").alias("m"),
        F.sum(F.when(~end, F.col("n"))).alias("weekday_orders"),
        F.sum(F.when(end, F.col("n"))).alias("weekend_orders"),
    )
    every = F.sum("total_orders").over(Window.partitionBy())
    return out.select(
        "hour_of_day",
        "total_orders",
        money(F.col("c")).alias("total_revenue"),
        rounded(F.col("m") / 100.0, 1).alias("avg_order_value"),
        "weekday_orders",
        "weekend_orders",
        ratio(F.col("total_orders"), every, 2).alias("pct_of_daily_orders"),
        big(F.rank().over(Window.orderBy(F.desc("total_orders")))).alias("volume_rank"),
    )


def discount_effect(fo: DataFrame) -> DataFrame:
    """Per code: sales, discounts, and the later orders of its users. Later than any use means later than the first,
    so one row per customer and code meets that customer's orders."""
    used = sold(fo).groupBy("order_id", "customer_key", F.coalesce("discount_code", F.lit("NO_DISCOUNT")).alias("discount_code"))
    used = used.agg(F.sum("total_cents").alias("g"), F.sum("discount_cents").alias("d"), F.count("total_cents").alias("k"))
    by = used.groupBy("discount_code").agg(
        big(F.count(F.lit(1))).alias("n"),
        n_distinct("customer_key").alias("unique_customers"),
        (F.sum("g") / F.sum("k")).alias("m"),
        F.sum("g").alias("g"),
        F.sum("d").alias("d"),
    )
    first = (
        fo.where("discount_code is not null")
        .groupBy("customer_key", F.col("discount_code").alias("code"))
        .agg(F.min("ordered_at").alias("first"))
    )
    orders = sold(fo).select("customer_key", "order_id", "ordered_at").distinct()
    # A customer has one first use of a code, so an order meets a code once.
    later = orders.join(first, "customer_key").where("ordered_at > first").groupBy("code").agg(F.count(F.lit(1)).alias("f"))
    df = by.join(later, by.discount_code == later.code, "left").withColumn("f", F.coalesce("f", F.lit(0)).cast("bigint"))
    return df.select(
        "discount_code",
        F.col("n").alias("order_count"),
        "unique_customers",
        money(F.col("g")).alias("gross_revenue"),
        money(F.col("d")).alias("total_discounts_given"),
        money(F.col("g") - F.col("d")).alias("net_revenue"),
        money(F.col("m")).alias("avg_order_value"),
        ratio(F.col("d"), F.col("g"), 2).alias("discount_pct_of_gross"),
        F.col("f").alias("follow_on_orders"),
        ratio(F.col("f"), F.col("n"), 1).alias("follow_on_conversion_rate_pct"),
    )


def revenue_forecast(fo: DataFrame, as_of: str | None = None, months: int = 12, horizon: int = 3) -> DataFrame:
    """Least-squares trend over monthly revenue from ``months`` back to now, and the next months on the line."""
    df = sold(with_as_of(fo, as_of, "order_date").where(F.col("order_date") >= F.add_months(month(F.col("as_of")), -months)))
    by = (
        df.groupBy(month(F.col("order_date")).alias("month"))
        .agg(F.sum("total_cents").alias("y"), F.max("as_of").alias("as_of"))
        .withColumn("x", F.row_number().over(Window.orderBy("month")))
    )
    line = by.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("base"),
        F.max("x").alias("last"),
        F.max("as_of").alias("now"),
    )
    on = lambda x: rounded((F.col("slope") * x + F.col("base")) / 100.0, 1)
    none = F.lit(None).cast("double")
    actual = by.crossJoin(F.broadcast(line)).select(
        "month",
        money(F.col("y")).alias("actual_revenue"),
        on(F.col("x")).alias("trend_revenue"),
        none.alias("forecast_revenue"),
        F.lit("actual").alias("data_type"),
    )
    ahead = line.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("n")).select(
        F.add_months(month(F.col("now")), F.col("n")).alias("month"),
        none.alias("actual_revenue"),
        none.alias("trend_revenue"),
        on(F.col("last") + F.col("n")).alias("forecast_revenue"),
        F.lit("forecast").alias("data_type"),
    )
    return actual.unionByName(ahead)


def kpi_dashboard(fo: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row: this month, last month, this year, in one pass over the facts."""
    df = with_as_of(fo, as_of, "order_date")
    this = month(F.col("order_date")) == month(F.col("as_of"))
    last = month(F.col("order_date")) == F.add_months(month(F.col("as_of")), -1)
    year = F.year("order_date") == F.year("as_of")
    ok = F.coalesce(F.col("order_status") != "cancelled", F.lit(False))
    recent = df.where(F.col("order_date") >= F.least(F.trunc("as_of", "year"), F.add_months(month(F.col("as_of")), -1)))
    sale = F.when(ok, F.col("total_cents"))
    order = recent.groupBy("order_id", "customer_key", "order_date", "as_of").agg(F.sum(sale).alias("c"), F.count(sale).alias("n"), F.max(ok).alias("ok"))
    cents = lambda when: F.sum(F.when(when, F.col("c")))
    one = order.agg(
        F.max("as_of").alias("report_date"),
        cents(this).alias("t"),
        cents(last).alias("l"),
        cents(year).alias("y"),
        (cents(this) / F.nullif(F.sum(F.when(this, F.col("n"))), F.lit(0))).alias("m"),
        n_where(F.col("ok") & this).alias("mtd_orders"),
        n_distinct("customer_key", F.col("ok") & this).alias("mtd_customers"),
        n_where(F.col("ok") & year).alias("ytd_orders"),
    )
    return one.select(
        "report_date",
        money(F.col("t")).alias("mtd_revenue"),
        money(F.col("l")).alias("prior_month_revenue"),
        ratio(F.col("t") - F.col("l"), F.col("l"), 1).alias("mom_growth_pct"),
        "mtd_orders",
        "mtd_customers",
        money(F.col("m")).alias("mtd_aov"),
        money(F.col("y")).alias("ytd_revenue"),
        "ytd_orders",
    )


def monthly_revenue(fo: DataFrame, as_of: str | None = None, months: int = 12) -> DataFrame:
    """Revenue, orders and mean order value per month, with the month before."""
    df = sold(with_as_of(fo, as_of, "order_date").where(F.col("order_date") >= F.add_months("as_of", -months)), NOT_SOLD)
    by = df.groupBy(month(F.col("order_date")).alias("m")).agg(n_distinct("order_id").alias("n"), F.sum("total_cents").alias("c"))
    before = F.lag("c").over(Window.orderBy("m"))
    return by.select(
        big(F.year("m")).alias("year"),
        F.date_format("m", "MMMM").alias("month_name"),
        F.col("n").alias("total_orders"),
        money(F.col("c")).alias("total_revenue"),
        rounded(F.col("c") / 100.0 / F.col("n"), 2).alias("avg_order_value"),
        money(before).alias("prev_month_revenue"),
        ratio(F.col("c") - before, before, 2).alias("mom_growth_pct"),
    )


def geo_top(fo: DataFrame, dc: DataFrame, n: int = 15) -> DataFrame:
    """Countries with most revenue."""
    place = dc.select(F.col("country_code").alias("shipping_country"), "state_province").distinct()
    by = sold(fo, NOT_SOLD).groupBy("shipping_country").agg(n_distinct("order_id").alias("orders"), F.sum("total_cents").alias("c"))
    return (
        by.join(place, "shipping_country")
        .orderBy(F.desc("c"), "shipping_country")
        .limit(n)
        .select(
            F.col("shipping_country").alias("country_name"),
            F.col("state_province").alias("region"),
            "orders",
            money(F.col("c")).alias("revenue"),
            rounded(F.col("c") / 100.0 / F.col("orders"), 2).alias("aov"),
        )
    )


def daily_sales(oh: DataFrame) -> DataFrame:
    """Per day over paid orders. A customer is new on a day unless an order that is not cancelled lies before it: the
    customer's first such order decides."""
    columns = ["customer_key", "created_at", "status", "payment_status", "payment_method", "total_cents", "discount_cents", "shipping_cents", "tax_cents"]
    first = F.when(F.col("status") != "cancelled", F.col("created_at"))
    df = (
        with_first(save(oh.select(*columns), "orders"), "customer_key", first)
        .where(F.col("payment_status").isin("captured", "partially_refunded", "refunded"))
        .withColumn("sale_date", F.col("created_at").cast("date"))
    )
    new = F.coalesce(F.col("first").cast("date") >= F.col("sale_date"), F.lit(True))
    # By customer and day first: then customers are counted, not kept distinct.
    sums = {"gross_revenue_cents": "total_cents", "total_discounts_cents": "discount_cents", "total_shipping_cents": "shipping_cents", "total_tax_cents": "tax_cents"}
    counts = {
        "cancelled_orders": F.col("status") == "cancelled",
        "refunded_orders": F.col("status") == "refunded",
        "credit_card_orders": F.col("payment_method") == "credit_card",
        "paypal_orders": F.col("payment_method") == "paypal",
    }
    per = df.groupBy("sale_date", "customer_key").agg(
        big(F.count(F.lit(1))).alias("order_count"),
        F.max(new).alias("new"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
        *[n_where(when).alias(name) for name, when in counts.items()],
    )
    every = ["order_count", *sums, *counts]
    by = per.groupBy("sale_date").agg(
        big(F.count(F.lit(1))).alias("unique_customers"),
        n_where(F.col("new")).alias("new_customer_count"),
        *[F.sum(c).alias(c) for c in every],
    )
    net = F.col("gross_revenue_cents") - F.col("total_shipping_cents") - F.col("total_tax_cents")
    mean = big(rounded(F.col("gross_revenue_cents") / F.col("order_count")))
    return by.withColumns({"net_revenue_cents": net, "avg_order_value_cents": mean})


def revenue_by_category(fo: DataFrame, dp: DataFrame, as_of: str | None = None, days: int = 90) -> DataFrame:
    """The last days by category."""
    df = sold(with_as_of(fo, as_of, "order_date").where(F.datediff("as_of", "order_date") <= days), NOT_SOLD).join(
        dp.select("product_key", "category_name"),
        "product_key",
    )
    return df.groupBy("category_name").agg(
        n_distinct("order_id").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("total_cents").alias("revenue_cents"),
        rounded(F.avg("unit_price_cents"), 2).alias("avg_unit_price_cents"),
    )
