"""Sums and values carried along ranges, and the operators on them: equal to plain versions, and no task has a hot key alone."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.functions import ranks
from tradewind.operators import customers, orders, products, revenue, warehouse


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("per_range", [10_000, 50, 7])
def test_carried_sums_and_values(spark, per_range):
    rng = random.Random(per_range)
    data = [(i, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 5]), rng.choice([None, None, f"v{i}"])) for i in range(600)]
    df = spark.createDataFrame(data, "id long, k string, t int, n long, v string").repartition(5)
    got = {r.id: (r.total, r.last) for r in ranks.carried(df, ["k"], ["t", "id"], {"total": F.col("n")}, {"last": F.col("v")}, per_range).collect()}
    want, total, last = {}, {}, {}
    for i, k, _, n, v in sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        total[k], last[k] = total.get(k, 0) + (n or 0), v or last.get(k)
        want[i] = (total[k], last[k])
    assert got == want
    assert ranks.carried(df.limit(0), ["k"], ["t"], {"total": F.col("n")}).count() == 0
    assert ranks.carried(df, ["k"], ["t"], {"total": F.col("n")}, rows_per_range=per_range).columns == [*df.columns, "total"]


def test_a_hot_key_spreads_over_ranges(spark):
    df = spark.range(4000).select(F.lit("one").alias("k"), F.lit(0).alias("t"), "id")
    found = ranks._sorted(df.withColumn("__tie", F.monotonically_increasing_id()), [F.col("k"), F.col("t"), F.col("__tie")], 8)
    sizes = [r["count"] for r in found.groupBy("__range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    out = ranks.carried(df, ["k"], ["t"], {"n": F.lit(1)}, rows_per_range=500)
    assert sorted(r.n for r in out.collect()) == list(range(1, 4001))


@pytest.mark.parametrize("per_range", [100_000, 100])
def test_one_code_and_one_product_for_all(spark, per_range):
    start = datetime(2024, 1, 1)
    req = [(i, start + timedelta(seconds=i % 60), "A", 1000, 0) for i in range(1500)]
    df = spark.createDataFrame(req, "request_id long, at timestamp, discount_code string, subtotal_cents long, shipping_cents long").repartition(4)
    codes = spark.createDataFrame([("A", "fixed_amount", 1.0, 0, 1000, 7, True, start, None)], "code string, discount_type string, discount_value double, minimum_cents long, maximum_uses long, current_uses long, is_active boolean, valid_from timestamp, valid_until timestamp")
    first = {i for i, *_ in sorted(req, key=lambda r: (r[1], r[0]))[:993]}
    got = orders.apply_discounts(df, codes, per_range).collect()
    assert {r.request_id for r in got if r.reason is None} == first and len(got) == 1500
    items = df.select("request_id", F.lit(1).alias("product_key"), F.lit(2).alias("quantity"), "at")
    stock = spark.createDataFrame([(1, 2001)], "product_key int, quantity_available long")
    done = orders.reserve_stock(items, stock, per_range).collect()
    assert {r.request_id for r in done if r.reserved} == {i for i, *_ in sorted(req, key=lambda r: (r[1], r[0]))[:1000]}
    assert sorted(r.asked for r in done) == list(range(2, 3002, 2))


def _history(rng, key, n):
    days = sorted(rng.sample(range(1000), n))
    day = lambda x: date(2020, 1, 1) + timedelta(days=x)
    for i, d in enumerate(days):
        end = days[i + 1] if i + 1 < n else None
        # Some versions end before the next begins.
        yield (key, day(d), None if end is None else day(end - (i % 3 == 0 and end - d > 1)), f"{key}-{i}")


@pytest.mark.parametrize("per_range", [100_000, 60])
def test_as_of_equals_the_interval_join(spark, per_range):
    rng = random.Random(3)
    dim = [v for k in (1, 2, 3) for v in _history(rng, k, 40)] + [(4, date(2020, 5, 5), date(2020, 5, 5), "empty"), (4, date(2020, 5, 5), None, "full"), (None, date(2020, 1, 1), None, "no key"), (5, None, None, "no start")]
    facts = [(i, rng.choice([1, 1, 1, 2, 3, 4, 5, 9, None]), rng.choice([None] + [date(2019, 12, 25) + timedelta(days=rng.randint(0, 1050)) for _ in range(9)])) for i in range(700)]
    d = spark.createDataFrame(dim, "k long, effective_from date, effective_to date, tier string").repartition(3)
    f = spark.createDataFrame(facts, "id long, k long, day date").repartition(3)
    got = warehouse.as_of_join(f, d, "k", "day", per_range)
    on = (f.k == d.k) & (d.effective_from <= f.day) & (d.effective_to.isNull() | (f.day < d.effective_to))
    want = f.join(d, on, "left").select("id", f.k, "day", "effective_from", "effective_to", "tier")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_a_long_history_makes_no_product(spark):
    start = F.lit("2020-01-01").cast("date")
    dim = spark.range(100_000).select(F.lit(1).alias("k"), F.date_add(start, F.col("id").cast("int")).alias("effective_from"), F.date_add(start, F.col("id").cast("int") + 1).alias("effective_to"), "id")
    fact = spark.range(100_000).select(F.lit(1).alias("k"), F.date_add(start, (F.col("id") * 7 % 100_000).cast("int")).alias("day"), F.col("id").alias("f"))
    out = warehouse.as_of_join(fact, dim, "k", "day", 20_000)
    assert out.agg(F.count("id"), F.sum("id")).first() == (100_000, 100_000 * 99_999 // 2)
    assert "Join" not in "".join(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x and "__range" not in x and "__at" not in x)


def test_audit_times_of_a_history(spark):
    dim = spark.createDataFrame([(1, "a", date(2024, 1, 1), None, True), (2, "b", date(2024, 1, 1), None, True)], "k long, tier string, effective_from date, effective_to date, is_current boolean")
    source = spark.createDataFrame([(1, "x"), (2, "b"), (3, "n")], "k long, tier string")
    one = warehouse.scd2_apply(dim, source, ["k"], ["tier"], "2024-02-01", now="2024-02-01 03:00:00")
    t1, t2 = datetime(2024, 2, 1, 3), datetime(2024, 3, 1, 3)
    pick = lambda df: {(r.k, r.tier): (r.is_current, r.dw_created_at, r.dw_updated_at) for r in df.collect()}
    assert pick(one) == {(1, "a"): (False, None, t1), (1, "x"): (True, t1, t1), (2, "b"): (True, None, None), (3, "n"): (True, t1, t1)}
    two = warehouse.scd2_apply(one, source.where("k <> 3").unionByName(spark.createDataFrame([(3, "m")], "k long, tier string")), ["k"], ["tier"], "2024-03-01", now="2024-03-01 03:00:00")
    assert pick(two)[3, "n"] == (False, t1, t2) and pick(two)[3, "m"] == (True, t2, t2) and pick(two)[1, "x"] == (True, t1, t1)


@pytest.mark.parametrize("tile", [512, 4, 1])
def test_tiles_give_all_pairs_once(spark, tile):
    rng = random.Random(tile)
    data = [("heavy", i, i + 1) for i in range(37)] + [(f"c{c}", i, rng.randint(1, 9)) for c in range(5) for i in rng.sample(range(37), 3)] + [("single", 1, 1)]
    df = spark.createDataFrame(data, "c string, item int, s int").repartition(3)
    got = rows(products.tiled_pairs(df, "c", "item", "s", tile))
    want = [(a, b, va, vb) for c in {r[0] for r in data} for x, a, va in data if x == c for y, b, vb in data if y == c and a < b]
    assert got == sorted(want, key=repr)


def test_a_large_group_meets_in_many_keys(spark):
    df = spark.range(400).select(F.lit("one").alias("c"), F.col("id").alias("item"), F.lit(1).alias("s"))
    pairs = products.tiled_pairs(df, "c", "item", "s", 40)
    assert pairs.count() == 400 * 399 // 2
    # Ten blocks meet in 55 keys, none with much over its share of the rows.
    block = F.pmod(F.xxhash64("item"), F.lit(10))
    sizes = [r["count"] for r in df.groupBy(block).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 80


@pytest.mark.parametrize("per_range", [100_000, 30])
def test_rows_in_the_last_hour_of_one_address(spark, per_range):
    rng = random.Random(4)
    data = [(i, rng.choice(["hot", "hot", "x", None]), rng.choice([0, 3600, 3601, 7200, rng.randint(0, 9000)])) for i in range(300)]
    df = spark.createDataFrame(data, "id long, k string, at long")
    want = {i: sum(k == kk and at - 3600 <= b <= at for _, kk, b in data) for i, k, at in data}
    assert {r.id: r.n for r in customers._lately(df, "k", 3600, "n", per_range).collect()} == want


def test_sketched_ranks_are_near(spark):
    df = spark.range(20_000).select(F.col("id").alias("customer_key"), (F.col("id") * F.col("id") % 10_007).alias("v"))
    n = 20_000
    for down in (False, True):
        exact = {r.customer_key: r.a_rank for r in ranks.global_positions(df, {"a": ("v", down)}, "customer_key", ranked=("a",)).collect()}
        near = ranks.approximate_positions(df, {"a": ("v", down)}, "customer_key", ranked=("a",)).collect()
        off = max(abs(r.a_row - exact[r.customer_key]) for r in near) / n
        assert off < 0.006 and {r.a_n for r in near} == {n} and all(1 <= r.a_row <= n for r in near)
    assert ranks.approximate_positions(df.limit(0), {"a": ("v", False)}, "customer_key").count() == 0


def test_first_orders_are_joined_back(spark):
    day = lambda d: datetime(2024, 1, d)
    oh = spark.createDataFrame([(c, day(d), s, "captured", "paypal", 100, 0, 0, 0) for c, d, s in ((1, 1, "cancelled"), (1, 2, "delivered"), (1, 3, "delivered"), (None, 2, "delivered"), (None, 3, "delivered"))], "customer_key long, created_at timestamp, status string, payment_status string, payment_method string, total_cents long, discount_cents long, shipping_cents long, tax_cents long")
    got = {r.sale_date.day: (r.order_count, r.new_customer_count) for r in revenue.daily_sales(oh).collect()}
    assert got == {1: (1, 1), 2: (2, 2), 3: (2, 0)}


def test_days_without_orders_can_be_filled(spark):
    fo = spark.createDataFrame([(i, 1, date(2024, 1, d), "delivered", 100 * d) for i, d in enumerate((1, 2, 5, 9))], "order_id long, customer_key long, order_date date, order_status string, total_cents long")
    got = {r.full_date.day: r for r in revenue.revenue_growth(fo, as_of="2024-01-09", fill=True).collect()}
    assert sorted(got) == list(range(1, 10)) and [got[d].revenue_cents for d in (3, 5, 9)] == [0, 500, 900]
    assert (got[5].prev_day_revenue, got[5].dod_growth_pct, got[9].same_day_last_week, got[8].same_day_last_week, got[9].ytd_revenue) == (0, None, 200, 100, 1700)
    assert len(revenue.revenue_growth(fo, as_of="2024-01-09").collect()) == 4


def test_items_as_an_array_or_as_json(spark):
    items = [{"product_key": 1, "quantity": 2}, {"product_key": 9, "quantity": 1}]
    req = spark.createDataFrame([(1, 5, datetime(2024, 1, 1), items), (2, 5, datetime(2024, 1, 1), [])], "request_id long, customer_key long, at timestamp, items array<struct<product_key:long,quantity:long>>")
    text = req.withColumn("items", F.to_json("items"))
    products_ = spark.createDataFrame([(1, 300, None, True), (2, 100, 50, False)], "product_key long, base_price_cents long, sale_price_cents long, is_active boolean")
    stock = spark.createDataFrame([(1, 1)], "product_key long, quantity_available long")
    for r in (req, text):
        assert rows(orders.request_items(r).select("request_id", "product_key", "quantity")) == [(1, 1, 2), (1, 9, 1)]
        assert rows(orders.assess_items(orders.request_items(r), products_, stock)) == [(1, 600, 1, 1, 1)]
