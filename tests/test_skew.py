"""Operators whose keys may hold a large part of all rows: equal to plain versions, and no partition gets them all."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.functions import ranks
from tradewind.operators import customers, orders, products


def test_equal_values_spread_over_ranges(spark):
    df = spark.range(2000).withColumn("v", F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).cast("long"))
    found = ranks._sorted(df, [F.col("v").asc(), F.col("id")], 16)
    sizes = [r["count"] for r in found.groupBy("__range").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 500
    got = ranks.global_positions(df, {"a": ("v", False), "b": ("v", True)}, "id", ranked=("a", "b"), ranges=16).collect()
    for name, down in (("a", False), ("b", True)):
        order = sorted(got, key=lambda r: (-r.v if down else r.v, r.id))
        assert [r[f"{name}_row"] for r in order] == list(range(1, 2001)) and {r[f"{name}_n"] for r in got} == {2000}
        first = {}
        for i, r in enumerate(order, 1):
            assert r[f"{name}_rank"] == first.setdefault(r.v, i)


def test_values_beyond_doubles_keep_their_order(spark):
    big = 2**53
    df = spark.createDataFrame([(i, big + i) for i in range(50)], "id long, v long")
    got = ranks.global_positions(df, {"a": ("v", True)}, "id", ranges=4).collect()
    assert {r.id: r.a_row for r in got} == {i: 50 - i for i in range(50)}


@pytest.fixture
def requests():
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    return [(i, start + timedelta(minutes=rng.randint(0, 6000)), rng.choice([None, None, None, "A", "A", "A", "a", "B", "C", "?"]), rng.randint(50, 3000), 100) for i in range(600)]


def test_turns_are_given_in_request_order(spark, requests):
    codes = [("A", "fixed_amount", 5.0, 100, 40, 3, True, datetime(2024, 1, 1), None), ("B", "percentage", 10.0, 0, 0, 0, True, datetime(2024, 1, 1), None), ("C", "free_shipping", 0.0, 0, None, 0, True, datetime(2024, 1, 1), datetime(2024, 1, 3))]
    c = spark.createDataFrame(codes, "code string, discount_type string, discount_value double, minimum_cents long, maximum_uses long, current_uses long, is_active boolean, valid_from timestamp, valid_until timestamp")
    df = spark.createDataFrame(requests, "request_id long, at timestamp, discount_code string, subtotal_cents long, shipping_cents long").repartition(4)
    used, want = {"A": 3, "B": 0, "C": 0}, {}
    by = {x[0]: x for x in codes}
    for i, at, code, sub, ship in sorted(requests, key=lambda r: (r[1], r[0])):
        x = by.get((code or "").upper())
        if code is None:
            want[i] = (0, None)
        elif x is None or (x[8] and at >= x[8]):
            want[i] = (0, "P0006")
        elif sub < x[3]:
            want[i] = (0, "P0007")
        elif x[4] is not None and used[x[0]] >= x[4]:
            want[i] = (0, "P0008")
        else:
            used[x[0]] += 1
            want[i] = ({"A": min(500, sub), "B": int(sub * 0.1 + 0.5), "C": ship}[x[0]], None)
    assert {r.request_id: (r.discount_cents, r.reason) for r in orders.apply_discounts(df, c).collect()} == want


def test_stock_is_reserved_in_order_over_days(spark, requests):
    items = [(i, i % 3, i % 7 + 1, at) for i, at, *_ in requests]
    df = spark.createDataFrame(items, "request_id long, product_key long, quantity long, at timestamp").repartition(4)
    stock = spark.createDataFrame([(0, 300), (1, 10_000)], "product_key long, quantity_available long")
    asked, want = {}, {}
    for i, p, q, _ in sorted(items, key=lambda x: (x[3], x[0])):
        asked[p] = asked.get(p, 0) + q
        want[i] = (asked[p], asked[p] <= {0: 300, 1: 10_000}.get(p, 0))
    assert {r.request_id: (r.asked, r.reserved) for r in orders.reserve_stock(df, stock).collect()} == want


def test_rows_in_the_last_hour(spark):
    rng = random.Random(4)
    data = [(i, rng.choice(["hot", "hot", "hot", "x", None]), rng.randint(-9000, 20_000)) for i in range(400)]
    df = spark.createDataFrame(data, "id long, k string, at long")
    want = {i: sum(k == kk and at - 3600 <= b <= at for _, kk, b in data) for i, k, at in data}
    got = {r.id: r.n for r in customers._lately(df, "k", 3600, "n").collect()}
    assert got == want and len(got) == 400


def test_upserts_with_ties_and_without_unique_values(spark):
    t = spark.createDataFrame([(i, None if i % 2 else f"e{i}") for i in range(40)], "k long, email string")
    c = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "z", 4), (3, "e2", 1), (50, None, 1)], "k long, email string, at int").repartition(3)
    after, bad = orders.upsert_entities(t, c, "k", "email", ["email"], [])
    got = {r.k: r.email for r in after.collect()}
    assert got[1] == "b" and got[3] is None and got[50] is None and len(got) == 41
    assert [tuple(r) for r in bad.collect()] == [(3, "unique value taken")]


FO = "order_id long, customer_key long, product_key long, order_status string, quantity long"


def facts(spark, seed, customers_=60, products_=40):
    rng = random.Random(seed)
    data = [(i, rng.randrange(customers_) ** 2 // customers_, rng.randrange(products_), rng.choice(["delivered"] * 9 + ["cancelled"]), rng.randint(1, 5)) for i in range(900)]
    return data, spark.createDataFrame(data, FO)


def test_recommendations_of_a_hot_tier(spark):
    data, fo = facts(spark, 2)
    dp, dc = [(p, f"c{p % 3}") for p in range(40)], [(c, "gold" if c % 8 else "silver") for c in range(60)]
    category, tier = dict(dp), dict(dc)
    had = {(c, p) for _, c, p, s, _ in data if s != "cancelled"}
    buyers = {}
    for c, p in had:
        buyers[tier[c], p] = buyers.get((tier[c], p), 0) + 1
    want = set()
    for c in {c for c, _ in had}:
        near = {category[p] for _, x, p, _, _ in data if x == c}
        options = sorted((-n, p) for (t, p), n in buyers.items() if t == tier[c] and category[p] in near and (c, p) not in had)[:5]
        want |= {(c, p, category[p], -n, i) for i, (n, p) in enumerate(options, 1)}
    out = customers.cross_sell(fo, spark.createDataFrame(dp, "product_key long, category_name string"), spark.createDataFrame(dc, "customer_key long, loyalty_tier string"), parts=4)
    assert {tuple(r) for r in out.collect()} == want


def test_similar_items_need_common_customers(spark):
    data, fo = facts(spark, 3)
    dp = spark.createDataFrame([(p,) for p in range(40)], "product_key long")
    q, total = {}, {}
    for _, c, p, s, n in data:
        if s != "cancelled":
            q[c, p] = q.get((c, p), 0) + n
            total[c] = total.get(c, 0) + n
    share = {k: n * 1_000_000 // total[k[0]] for k, n in q.items()}
    want = {}
    for a in range(40):
        for b in range(a + 1, 40):
            both = [c for c in total if (c, a) in share and (c, b) in share]
            if len(both) >= 12:
                dot, aa, bb = (sum(share[c, x] * share[c, y] for c in both) for x, y in ((a, b), (a, a), (b, b)))
                cos = dot / (aa**0.5 * bb**0.5)
                if cos > 0.1:
                    want[a, b] = (len(both), round(cos, 4))
    got = {(r.item_a, r.item_b): (r.common_customers, r.cosine_similarity) for r in products.item_similarity(fo, dp, min_common=12, limit=1000).collect()}
    assert got.keys() == want.keys() and got and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=2e-4) for k in want)
