"""Load, quality, streaming, order and retention rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions import clean
from tradewind.operators import listing, orders, quality, warehouse
from tradewind.plans import pipeline
from tradewind.sources import lake
from tradewind.streaming import events as stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_clean_strings(spark):
    df = spark.createDataFrame([(" a ", 1), ("NULL", 2), (" n/a ", 3), ("", 4), (None, 5), ("none of it", 6)], "s string, n int")
    assert [r.s for r in clean.clean_strings(df).orderBy("n").collect()] == ["a", None, None, None, None, "none of it"]


def test_partition_columns_fall_back(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5), datetime(2020, 1, 1))], "occurred_at timestamp, created_at timestamp")
    r = clean.add_partition_cols(df).first()
    assert (r.year, r.month, r.day) == ("2024", "03", "05")
    with pytest.raises(ValueError):
        clean.add_partition_cols(spark.range(1))


def test_row_hash_keeps_null_and_empty_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string").select(clean.row_hash(["y", "x"]).alias("h"))
    assert df.distinct().count() == 1


def test_calendar(spark):
    r = {x.full_date: x for x in clean.date_dim(spark, "2023-12-30", "2024-04-01").collect()}
    assert r[date(2024, 3, 31)].fiscal_year == 2023 and r[date(2024, 4, 1)].fiscal_year == 2024 and r[date(2024, 4, 1)].fiscal_quarter == 1
    assert r[date(2023, 12, 31)].day_of_week == 0 and r[date(2024, 1, 1)].week_of_year == 1 and len(r) == 94
    assert clean.date_dim(spark).count() == 4018


def test_pages(spark):
    df = spark.range(45)
    last = listing.paginate(df, ["id"], page=3)
    assert [r.id for r in last.orderBy("id").collect()] == list(range(40, 45)) and last.first().pages == 3
    assert listing.paginate(df, ["id"], page=0, limit=500).count() == 45
    with pytest.raises(ValueError):
        listing.list_orders(df, df, status="partially")


def dim(spark, data):
    return spark.createDataFrame(data, "k long, tier string, effective_from date, effective_to date, is_current boolean")


def test_history_is_valid_after_repeated_loads(spark):
    d = dim(spark, [(1, "a", date(2024, 1, 1), None, True), (2, "b", date(2024, 1, 1), None, True)])
    for day, data in (("2024-02-01", [(1, "x"), (3, "c")]), ("2024-02-01", [(1, "x"), (3, "c")]), ("2024-03-01", [(1, "y"), (2, None)])):
        d = spark.createDataFrame(warehouse.scd2_apply(d, spark.createDataFrame(data, "k long, tier string"), ["k"], ["tier"], day).collect(), d.schema)
    got = rows(d)
    assert [g for g in got if g[0] == 1] == [(1, "a", date(2024, 1, 1), date(2024, 2, 1), False), (1, "x", date(2024, 2, 1), date(2024, 3, 1), False), (1, "y", date(2024, 3, 1), None, True)]
    assert d.where("is_current").groupBy("k").count().where("count <> 1").count() == 0
    fact = spark.createDataFrame([(1, date(2024, 1, 31)), (1, date(2024, 2, 1)), (9, date(2024, 2, 1))], "k long, day date")
    assert rows(warehouse.as_of_join(fact, d, "k", "day").select("k", "day", "tier")) == [(1, date(2024, 1, 31), "a"), (1, date(2024, 2, 1), "x"), (9, date(2024, 2, 1), None)]


def test_counts_of_changes(spark):
    src, cur = spark.createDataFrame([(1, "a"), (2, "z"), (3, "n")], "k long, tier string"), dim(spark, [(1, "a", None, None, True), (2, "b", None, None, True), (4, "g", None, None, True)])
    assert rows(warehouse.scd2_counts(warehouse.scd2_diff(src, cur, ["k"], ["tier"]))) == [("changed", 1), ("new", 1), ("unchanged", 1)]


def test_keys_are_consecutive(spark):
    own = spark.range(100, 400).withColumnRenamed("id", "n")
    have = warehouse.assign_keys(own.repartition(5), ["n"], "id", 7)
    assert sorted(tuple(r) for r in have.collect()) == [(n, n - 93) for n in range(100, 400)]
    more = warehouse.assign_keys(spark.range(90, 100).withColumnRenamed("id", "n"), ["n"], "id", existing=have)
    assert sorted(tuple(r) for r in more.collect()) == [(n, n + 217) for n in range(90, 100)]


def test_places_keep_their_keys(spark):
    dc = spark.createDataFrame([("b", "x", "1"), ("a", None, "2"), ("a", None, "2")], "country_code string, state_province string, city string")
    first = warehouse.geo_dim(dc)
    assert rows(first) == [("a", None, "2", 1), ("b", "x", "1", 2)]
    later = dc.unionByName(spark.createDataFrame([("a", "a", "a")], dc.schema))
    assert rows(warehouse.geo_dim(later, existing=first)) == [("a", "a", "a", 3), ("a", None, "2", 1), ("b", "x", "1", 2)]


def test_loads_are_idempotent(spark):
    target = spark.createDataFrame([(1, "old")], "k long, v string")
    df = spark.createDataFrame([(1, "new"), (2, "new"), (2, "twice")], "k long, v string")
    once = warehouse.insert_ignore(df, target, ["k"])
    assert once.count() == 2 and warehouse.append_new(df, once, "k").count() == 0


def test_category_paths(spark):
    c = spark.createDataFrame([(1, "top", None), (2, "mid", 1), (3, "leaf", 2)], "category_id long, name string, parent_id long")
    assert rows(warehouse.category_paths(spark, c)) == [(1, "top"), (2, "top / mid"), (3, "top / mid / leaf")]
    assert rows(warehouse.resolve_categories(c)) == [(1, "top", None), (2, "mid", "top"), (3, "leaf", "mid")]


def test_watermarks(spark, tmp_path):
    p = f"file://{tmp_path}/state"
    first = warehouse.get_watermark(spark, p, "t", "2024-01-01 10:00:00").first()
    assert first.lo == datetime(2024, 1, 1, 8)
    warehouse.put_watermark(spark, p, "t", "2024-01-01 10:00:00")
    assert warehouse.get_watermark(spark, p, "t", "2024-01-02 00:00:00").first().lo == datetime(2024, 1, 1, 10)
    assert warehouse.get_watermark(spark, p, "other", "2024-01-02 00:00:00").first().lo == datetime(2024, 1, 1, 22)


def test_checks_find_injected_faults(spark):
    df = spark.createDataFrame([(1, 5, datetime(2024, 1, 1)), (1, None, datetime(2024, 1, 1)), (None, 50, None), (None, 7, None)], "k long, v int, at timestamp")
    rules = quality.Rules(("k", "v"), ("k", "v"), {"v": (0, 10)}, "k", 0.3, "at", 3.0)
    got = {(r.check_name, r.column_name): (r.severity, r.status, r.bad) for r in quality.run_checks(df, "t", rules, "2024-01-01 02:00:00", {"k": (spark.createDataFrame([(1,)], "id long"), "id")}).collect()}
    assert got == {("schema", None): ("INFO", "PASSED", 0), ("null_rate", "k"): ("CRITICAL", "FAILED", 2), ("null_rate", "v"): ("WARNING", "FAILED", 1), ("range", "v"): ("CRITICAL", "FAILED", 1), ("duplicates", "k"): ("CRITICAL", "FAILED", 2), ("freshness", "at"): ("INFO", "PASSED", 0), ("referential", "k"): ("WARNING", "FAILED", 2)}
    assert quality.duplicate_rows(df, "k").count() == 4
    with pytest.raises(quality.QualityError):
        quality.quality_gate({"t": (df, rules)})
    empty = quality.check_nulls(df.limit(0), "t", ("k",), 0.1).first()
    assert (empty.severity, empty.status) == ("WARNING", "FAILED")
    assert quality.run_checks(df, "t", quality.Rules(("nope",), ("k",))).count() == 1


def test_raw_files(spark, tmp_path):
    (tmp_path / "good.csv").write_text('event_id,event_type,occurred_at\n1,"a,b",2024\n2,x,2024\n')
    (tmp_path / "bad.csv").write_text("event_id,kind\n1,2,3\n,2\n")
    got = {r.file.rsplit("/", 1)[1]: r for r in quality.validate_csv(quality.read_lines(spark, f"file://{tmp_path}"), "events").collect()}
    assert (got["good.csv"].rows, got["good.csv"].malformed, got["good.csv"].status) == (2, 0, "VALID")
    assert (got["bad.csv"].malformed, got["bad.csv"].missing_columns, got["bad.csv"].status) == (1, "event_type,occurred_at", "INVALID")
    lines = spark.createDataFrame([("f", '{"event_id":1,"event_type":"x","occurred_at":"t"}'), ("f", "[1]"), ("g", '{"event_id":1,"event_type":"x","occurred_at":"t"}')], "file string, value string")
    out = quality.validate_jsonl(lines, "events")
    assert {r.file: r.status for r in out.collect()} == {"f": "INVALID", "g": "VALID"}
    assert {r.file: r.zone for r in quality.route_files(out).collect()} == {"f": "quarantine", "g": "processed"}


BODIES = [
    ("1", '{"event_type": " PURCHASE ", "occurred_at": "2024-01-01T10:00:00Z", "event_id": "bad", "properties": {"a": 1}}'),
    ("2", '[{"event_type": "search", "occurred_at": 1704103200000, "search_query": "' + "q" * 600 + '"}, {"event_type": "search"}]'),
    ("3", "7"),
    ("4", "{broken"),
    ("5", '{"occurred_at": "2024-01-01"}'),
    ("6", '{"event_type": "dance"}'),
    ("7", '{"event_type": "search", "occurred_at": "yesterday"}'),
    ("8", '{"event_type": "search", "customer_id": "123E4567-e89b-12d3-a456-426614174000", "session_id": "x"}'),
    ("9", '[{"event_type": "search"}, 5]'),
]


def test_message_rules(spark):
    got = {(r.message_id, r.pos): r for r in stream.validate_events(stream.parse_events(spark.createDataFrame(BODIES, "message_id string, body string")), "2024-05-05 00:00:00").collect()}
    assert got["1", 0].event_type == "purchase" and got["1", 0].occurred_at == datetime(2024, 1, 1, 10) and len(got["1", 0].event_id) == 36 and got["1", 0].properties == '{"a":1}' and got["1", 0].error is None
    assert got["2", 0].occurred_at == datetime(2024, 1, 1, 10) and len(got["2", 0].search_query) == 500 and got["2", 1].occurred_at == datetime(2024, 5, 5)
    assert got["8", 0].customer_id == "123e4567-e89b-12d3-a456-426614174000" and got["8", 0].session_id is None
    assert {k for k, r in got.items() if r.error} == {("3", 0), ("4", 0), ("5", 0), ("6", 0), ("7", 0), ("9", 0)}


def test_stream_restart_and_redelivery_add_nothing(spark, tmp_path):
    base = f"file://{tmp_path}"
    good = [b for b in BODIES if b[0] in "128"]
    df = spark.createDataFrame(good + BODIES[2:4], "message_id string, body string")
    df.coalesce(1).write.mode("append").json(f"{base}/in")

    def go(checkpoint):
        raw = spark.readStream.schema("message_id string, body string").json(f"{base}/in")
        stream.start_ingest(raw, f"{base}/t", f"{base}/l", f"{base}/m-{checkpoint}", f"{base}/{checkpoint}", once=True).awaitTermination()
        return spark.read.parquet(f"{base}/t").count()

    first = go("c1")
    assert first == 4 and go("c1") == first
    # All messages come again, also those that say no time and so get another one.
    df.coalesce(1).write.mode("append").json(f"{base}/in")
    assert go("c1") == first and go("c2") == first
    assert {r.message_id for r in spark.read.parquet(f"{base}/l").collect()} == {"3", "4"}
    sums = lambda c: rows(spark.read.parquet(f"{base}/m-{c}").selectExpr("sum(valid)", "sum(inserted)", "sum(failed)", "min(elapsed_ms) > 0"))
    assert sums("c1") == [(8, 4, 4, True)] and sums("c2") == [(8, 0, 4, True)]


def test_the_time_of_sending_stands_for_an_absent_time(spark):
    raw = spark.createDataFrame([("1", '{"event_type": "search"}', datetime(2024, 3, 1))], "message_id string, body string, sent_at timestamp")
    got = stream.validate_events(stream.parse_events(raw), "2024-05-05 00:00:00").first()
    assert got.occurred_at == datetime(2024, 3, 1) and not got.timed


def test_stream_funnel_counts_a_session_once_a_day(spark, tmp_path):
    base = f"file://{tmp_path}"
    at = [datetime(2024, 1, d, h) for d in (1, 2, 3, 4, 5) for h in (1, 2, 3)]
    data = [(k, f"s{i % 2}", t) for i, t in enumerate(at) for k in ("page_view", "purchase", "page_view", "other")]
    spark.createDataFrame(data, "event_type string, session_id string, occurred_at timestamp").coalesce(1).write.parquet(f"{base}/in")
    raw = spark.readStream.schema("event_type string, session_id string, occurred_at timestamp").parquet(f"{base}/in")
    stream.stream_funnel(raw).writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    got = {r.event_date.day: (r.page_view, r.purchase, r.product_view) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {d: (2, 2, 0) for d in (1, 2, 3)}


def test_discount_rules(spark):
    at = datetime(2024, 1, 1)
    codes = spark.createDataFrame([("P", "percentage", 10.0, 0, None, 0, True, at, None), ("F", "fixed_amount", 5.0, 1000, 2, 1, True, at, None), ("S", "free_shipping", 0.0, 0, None, 0, True, at, None), ("X", "percentage", 5.0, 0, None, 0, True, at, at)], "code string, discount_type string, discount_value double, minimum_cents long, maximum_uses long, current_uses long, is_active boolean, valid_from timestamp, valid_until timestamp")
    p = spark.createDataFrame([(1, at, "p", 1005, 100), (2, at, "F", 1000, 100), (3, at, "f", 2000, 100), (4, at, "F", 999, 100), (5, at, "s", 100, 70), (6, at, "X", 100, 0), (7, at, "none", 100, 0), (8, at, None, 100, 0), (9, at, "", 100, 0)], "request_id long, at timestamp, discount_code string, subtotal_cents long, shipping_cents long")
    got = {r.request_id: (r.discount_cents, r.reason) for r in orders.apply_discounts(p, codes).collect()}
    assert got == {1: (101, None), 2: (500, None), 3: (0, "P0008"), 4: (0, "P0007"), 5: (70, None), 6: (0, "P0006"), 7: (0, "P0006"), 8: (0, None), 9: (0, None)}


def test_requests_are_priced_checked_and_reserved(spark):
    at = datetime(2024, 1, 1)
    req = spark.createDataFrame([(1, 1, '[{"product_key":1,"quantity":2}]', at, 50), (2, 1, "[]", at, 0), (3, 2, '[{"product_key":1,"quantity":1}]', at, 0), (4, 1, '[{"product_key":9,"quantity":1}]', at, 0), (5, 1, '[{"product_key":2,"quantity":1}]', at, 0), (6, 1, '[{"product_key":1,"quantity":9}]', at, 0), (7, 1, '[{"product_key":1,"quantity":3}]', at, None)], "request_id long, customer_key long, items string, at timestamp, shipping_cents long")
    products = spark.createDataFrame([(1, 1000, 900, True), (2, 500, None, False), (9, 1, None, True)], "product_key long, base_price_cents long, sale_price_cents long, is_active boolean")
    stock = spark.createDataFrame([(1, 4), (2, 9)], "product_key long, quantity_available long")
    cust = spark.createDataFrame([(1, True, 3), (2, False, 0)], "customer_key long, is_active boolean, loyalty_points long")
    assert rows(orders.order_rejections(req, cust, products, stock)) == [(2, "P0002"), (3, "P0001"), (4, "P0003"), (5, "P0004"), (6, "P0005")]
    priced = {r.request_id: r for r in orders.price_orders(req, products).collect()}
    assert (priced[1].subtotal_cents, priced[1].tax_cents, priced[1].total_cents) == (1800, 144, 1994)
    items = orders.request_items(req.where("request_id in (1, 7)"))
    assert {r.request_id: r.reserved for r in orders.reserve_stock(items, stock).collect()} == {1: True, 7: False}
    assert rows(orders.loyalty_points(spark.createDataFrame([(1, 1994), (1, 99)], "customer_key long, total_cents long"), cust)) == [(1, 22), (2, 0)]


def test_status_and_upserts(spark):
    o = spark.createDataFrame([(1, "pending"), (2, "pending")], "order_id long, status string")
    u = spark.createDataFrame([(1, "Shipped", 1), (1, "delivered", 2), (1, "gone", 3), (2, None, 1)], "order_id long, status string, at int")
    assert rows(orders.status_updates(o, u)) == [(1, "delivered", 1, 2), (2, "pending", None, None)] and orders.rejected_updates(u).count() == 2
    t = spark.createDataFrame([(1, "a@x", True), (2, "b@x", True)], "k long, email string, is_active boolean")
    c = spark.createDataFrame([(1, None, False, 1), (2, "a@x", None, 1), (3, "c@x", True, 1), (4, None, True, 1)], "k long, email string, is_active boolean, at int")
    after, bad = orders.upsert_entities(t, c, "k", "email", ["email", "is_active"], ["email"])
    assert rows(after) == [(1, "a@x", False), (2, "b@x", True), (3, "c@x", True)]
    assert rows(bad) == [(2, "unique value taken"), (4, "missing required field")]


def test_lake_round_trip(spark, tmp_path):
    base = f"file://{tmp_path}"
    df = spark.createDataFrame([(1, datetime(2024, 1, 5)), (2, datetime(2024, 2, 6)), (3, datetime(2024, 2, 6, 23))], "id long, created_at timestamp")
    lake.write_lake(df, base, "t")
    day = lake.read_lake(spark, base, "t", "2024-02-06")
    assert rows(day.select("id", "month", "day")) == [(2, "02", "06"), (3, "02", "06")]
    pruned = next(x for x in day._jdf.queryExecution().explainString(day._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n") if x.startswith("PartitionFilters"))
    assert all(f"({c}#" in pruned or f"({c}" in pruned for c in ("year", "month", "day"))
    assert rows(lake.extract_window(df, "created_at", "2024-01-05 00:00:00", "2024-02-06 00:00:00").select("id")) == [(2,)]
    path = lake.export_window(df, "t", "created_at", "2024-02-06 00:00:00", "2024-02-07 00:00:00", f"{base}/csv")
    assert spark.read.option("header", True).csv(path).count() == 2 and '"2"' in "".join(r.value for r in spark.read.text(path).collect())
    assert lake.archive_old(spark, base, "t", f"{base}/old", "2026-02-01", dry_run=True) == [("t_2024_01", 1)] and lake.read_lake(spark, base, "t").count() == 3
    assert lake.archive_old(spark, base, "t", f"{base}/old", "2026-02-01") == [("t_2024_01", 1)]
    assert spark.read.option("header", True).csv(f"{base}/old/2026-02-01/t").count() == 1 and rows(lake.read_lake(spark, base, "t").select("id")) == [(2,), (3,)]
    assert rows(spark.read.parquet(f"{base}/old/log").select("table_name", "partition_name", "row_count")) == [("t", "t_2024_01", 1)]
    assert lake.archive_old(spark, base, "t", f"{base}/old", "2026-02-01") == []
    assert rows(lake.partition_gaps(df, "created_at", "2023-12-01", "2024-03-01")) == [(date(2023, 12, 1),), (date(2024, 3, 1),)]
    assert rows(lake.expired_partitions(df, "created_at", 1, "2024-03-01")) == [(date(2024, 1, 1), 1)]
    assert lake.months_from_days(91) == 4 and lake.months_from_days(20, "floor") == 1


def test_batch_chain_is_idempotent_and_gated(spark, tmp_path):
    src = spark.createDataFrame([(i, f" n{i} ", datetime(2024, 1, 1, i)) for i in range(5)], "id long, name string, updated_at timestamp")
    rules = quality.Rules(("id",), ("id",), {"id": (0, 100)}, "id")
    base = f"file://{tmp_path}"
    assert pipeline.run(spark, src, "t", "id", "updated_at", rules, base, "2024-01-01 02:00:00") == 2
    assert pipeline.run(spark, src, "t", "id", "updated_at", rules, base, "2024-01-01 09:00:00") == 2
    assert pipeline.run(spark, src, "t", "id", "updated_at", rules, base, "2024-01-01 09:00:00") == 0
    with pytest.raises(quality.QualityError):
        pipeline.run(spark, src.withColumn("id", F.lit(500)), "t", "id", "updated_at", rules, f"{base}/b", "2024-01-01 02:00:00")
    names = {r.name for r in spark.read.parquet(f"{base}/facts/t").collect()}
    assert names == {"n1", "n2", "n3", "n4"}
