"""Queries take whole tables: all orders in the lake and the append."""

import os

from pyspark.sql import functions as F

from tradewind.plans import QUERIES
from tradewind.sources.conform import fact_events, fact_orders, order_heads

SMALL = os.environ.get("SMALL_SF_DIR", "/root/testdata/sf0.001")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_all_orders_reach_the_lake(spark):
    heads = order_heads(spark, SMALL)
    assert heads.where("created_at < timestamp_ntz '2001-01-01'").count() > 0
    tables = {r.table_name: r.row_count for r in QUERIES["lake_tables"](spark, SMALL).collect()}
    events = fact_events(spark, SMALL).count()
    assert tables == {"orders": fact_orders(spark, SMALL).count(), "events": events, "raw_events": events, "customers": 150, "products": tables["products"]}
    assert rows(QUERIES["write_partitioned"](spark, SMALL)) == rows(heads.groupBy(F.date_format("created_at", "yyyy"), F.date_format("created_at", "MM")).count())
    assert QUERIES["register_partitions"](spark, SMALL).first().n == heads.count()


def test_all_facts_are_appended(spark):
    facts = fact_orders(spark, SMALL).select("order_id", "product_key", "quantity")
    assert rows(QUERIES["warehouse_append"](spark, SMALL)) == rows(facts)
