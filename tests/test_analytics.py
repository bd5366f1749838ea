"""Rules of the analytics operators on small hand-made frames: ties, nulls, zero denominators, month ends."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions.ranks import global_positions, percent_rank, tile
from tradewind.operators import customers, marketing, products, revenue

FO = "order_id long, customer_key long, product_key long, order_date date, ordered_at timestamp, order_status string, quantity long, unit_price_cents long, discount_cents long, tax_cents long, total_cents long, discount_code string, payment_method string, shipping_country string, payment_status string"


@pytest.fixture
def orders(spark):
    def make(rows):
        """(order, customer, product, day, status, quantity, total, code)"""
        full = [(o, c, p, d, datetime(d.year, d.month, d.day, o % 24), s, q, 100, 10, 5, t, code, "paypal", "US", "captured") for o, c, p, d, s, q, t, code in rows]
        return spark.createDataFrame(full, FO)

    return make


@pytest.mark.parametrize("n", [1, 2, 7, 10, 103])
def test_positions_equal_windows(spark, n):
    df = spark.range(n).withColumn("v", (F.col("id") * 7 % 5).cast("double")).repartition(3)
    ours = global_positions(df, {"p": ("v", False)}, "id", ranked=("p",), ranges=8).select("id", tile("p", 4).alias("t4"), tile("p", 10).alias("t10"), F.round(percent_rank("p"), 9).alias("pr"))
    from pyspark.sql.window import Window

    w = Window.orderBy("v", "id")
    want = df.select("id", F.ntile(4).over(w).cast("bigint").alias("t4"), F.ntile(10).over(w).cast("bigint").alias("t10"), F.round(F.percent_rank().over(Window.orderBy("v")), 9).alias("pr"))
    assert sorted(ours.collect()) == sorted(want.collect())


def test_null_status_is_dropped_and_months_cross_year_ends(orders):
    fo = orders([(1, 1, 1, date(2024, 1, 31), "delivered", 1, 100, None), (2, 1, 1, date(2024, 2, 1), "delivered", 1, 100, None), (3, 2, 1, date(2024, 2, 1), None, 1, 100, None), (4, 3, 1, date(2023, 12, 31), "pending", 1, 50, None), (5, 3, 1, date(2024, 1, 1), "pending", 1, 50, None)])
    got = {(r.cohort_month, r.months_since_cohort): r.retention_rate_pct for r in customers.cohort_retention(fo).collect()}
    assert got == {(date(2024, 1, 1), 0): 100.0, (date(2024, 1, 1), 1): 100.0, (date(2023, 12, 1), 0): 100.0, (date(2023, 12, 1), 1): 100.0}
    literal = customers.cohort_pivot(fo, literal=True).where("cohort_ym = 202312").first()
    assert literal.m1_pct is None and customers.cohort_pivot(fo).where("cohort_ym = 202312").first().m1_pct == 100.0


def test_churn_of_customers_without_orders(spark, orders):
    dc = spark.createDataFrame([(1, "gold", "web", "US", date(2023, 1, 1)), (2, "gold", "web", "US", date(2023, 6, 1))], "customer_key long, loyalty_tier string, acquisition_source string, country_code string, customer_since_date date")
    got = {r.customer_key: r for r in customers.churn_features(dc, orders([(1, 1, 1, date(2024, 1, 1), "delivered", 1, 1500, None)])).collect()}
    assert got[2].recency_days is None and got[2].is_churned == 0 and got[2].churn_risk_score is None and got[2].last_order_date == date(2023, 6, 1)
    assert got[1].churn_risk_score == 30.0 and got[1].avg_days_between_orders == 0.0


def test_later_orders_count_from_the_first_use(orders):
    d = date(2024, 1, 1)
    fo = orders([(1, 1, 1, d, "delivered", 1, 100, "A"), (2, 1, 1, d, "delivered", 1, 100, None), (3, 1, 1, d, "delivered", 1, 100, "A"), (4, 1, 1, d, "cancelled", 1, 100, None)])
    got = {r.discount_code: r.follow_on_orders for r in revenue.discount_effect(fo).collect()}
    assert got == {"A": 2, "NO_DISCOUNT": 0}


def test_attribution_conserves_revenue(spark, orders):
    fe = spark.createDataFrame([(1, datetime(2024, 1, 1), date(2024, 1, 1), 1, "s", "page_view", 1, "g", "cpc"), (2, datetime(2024, 1, 1), date(2024, 1, 1), 1, "s", "page_view", 1, "f", "social"), (3, datetime(2024, 1, 2), date(2024, 1, 2), 1, "s", "purchase", 1, "g", "cpc"), (4, datetime(2024, 1, 2), date(2024, 1, 2), 2, "s", "page_view", 1, "g", "cpc")], "event_id long, occurred_at timestamp, event_date date, customer_key long, session_id string, event_type string, product_key long, utm_source string, utm_medium string")
    out = marketing.attribution(fe, orders([(1, 1, 1, date(2024, 1, 1), "delivered", 1, 1001, None)])).collect()
    assert sum(r.first_touch_revenue for r in out) == sum(r.last_touch_revenue for r in out) == 10.01
    assert {r.utm_source: (r.first_touch_revenue, r.last_touch_revenue, r.linear_revenue) for r in out} == {"g": (10.01, 0.0, 5.01), "f": (0.0, 10.01, 5.01)}
    assert {r.utm_source: r.first_vs_last_pct_diff for r in out} == {"g": None, "f": -100.0}


def test_decile_shares_add_up(orders):
    fo = orders([(i, i, 1, date(2024, 1, 1), "delivered", 1, 100 * (i + 1), None) for i in range(25)])
    out = customers.ltv_deciles(fo).orderBy("decile").collect()
    assert [r.customer_count for r in out] == [3, 3, 3, 3, 3, 2, 2, 2, 2, 2]
    assert abs(sum(r.pct_of_total_revenue for r in out) - 100) < 0.6 and out[0].cumulative_revenue_from_top == 100.0


def test_cross_sell_skips_what_was_bought(spark, orders):
    dp = spark.createDataFrame([(i, "c") for i in range(10)], "product_key long, category_name string")
    dc = spark.createDataFrame([(c, "gold") for c in range(5)], "customer_key long, loyalty_tier string")
    d = date(2024, 1, 1)
    rows = [(c * 100 + p, c, p, d, "delivered", 1, 100, None) for c in range(4) for p in range(c, 8)] + [(999, 4, 1, d, "cancelled", 1, 100, None)]
    out = customers.cross_sell(orders(rows), dp, dc, k=2).collect()
    assert {(r.customer_key, r.recommendation_rank): r.product_key for r in out} == {(1, 1): 0, (2, 1): 1, (2, 2): 0, (3, 1): 2, (3, 2): 1}


def test_baskets_need_support(spark, orders):
    dp = spark.createDataFrame([(1,), (2,), (3,)], "product_key long")
    d = date(2024, 1, 1)
    rows = [(o, 1, p, d, "delivered", 1, 100, None) for o in range(10) for p in (1, 2)] + [(50, 1, 3, d, "delivered", 1, 1, None), (50, 1, 1, d, "delivered", 1, 1, None)]
    out = products.basket_pairs(orders(rows), dp).collect()
    assert [(r.item_a, r.item_b, r.co_purchase_count, r.orders_a, r.lift) for r in out] == [(1, 2, 10, 11, 1.0)]


def test_fraud_rules(spark):
    now = datetime(2024, 1, 10, 12)
    rows = [(i, 1, 1000, datetime(2024, 1, 10, 11, i), "pending", "captured", "US", "ip") for i in range(7)] + [(20, 2, 60_000, now, "pending", "captured", "FR", "x"), (21, 2, 100, datetime(2024, 1, 1), "pending", "captured", "US", "y"), (22, 2, 110, datetime(2024, 1, 2), "pending", "captured", "US", "y"), (23, 3, 10, datetime(2024, 1, 10), "cancelled", "captured", "US", "z")]
    oh = spark.createDataFrame(rows, "order_id long, customer_key long, total_cents long, created_at timestamp, status string, payment_status string, shipping_country string, ip_address string")
    out = {r.order_id: r for r in customers.fraud_flags(oh).collect()}
    assert out[6].risk_score == 65 and out[6].recommendation == "REVIEW"
    assert out[20].risk_score == 55 and "ANOMALOUS" in out[20].risk_flags and out[20].recommendation == "ALLOW"
    assert 21 not in out and 23 not in out


def test_stitching_takes_the_latest_session(spark):
    ev = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "a", 9)], "event_id long, anonymous_id string, customer_key long")
    se = spark.createDataFrame([("a", 5, 1), ("a", 6, 2), ("a", None, 3)], "anonymous_id string, customer_key long, started_at int")
    assert {r.event_id: r.customer_key for r in marketing.stitch_identity(ev, se).collect()} == {1: 6, 2: None, 3: 9}


def test_ratings_and_prices(spark):
    dp = spark.createDataFrame([(1,), (2,)], "product_key long")
    rv = spark.createDataFrame([(1, "published", 4), (1, "published", 5), (1, "draft", 1)], "product_key long, status string, rating int")
    assert sorted(tuple(r) for r in products.product_rating(rv, dp).collect()) == [(1, 2, 4.5), (2, 0, None)]
    v = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 12, "c")], "product_key long, price_cents long, effective_from string")
    assert [tuple(r) for r in products.price_history(v).collect()] == [(1, 10, 12, "c")]
