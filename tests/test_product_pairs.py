"""Pairs are of products, not of brands."""

import os

import duckdb
import pytest

from tradewind.plans import QUERIES, SQL

SMALL = os.environ.get("SMALL_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["basket_pairs", "item_similarity"])
def test_products_not_brands_are_paired(spark, name):
    data = os.environ.get("PAIRS_SF_DIR", SMALL)
    con = duckdb.connect()
    for t in os.listdir(data):
        if t.endswith(".parquet"):
            con.sql(f"create view {t[:-8]} as select * from read_parquet('{data}/{t}')")
    assert SQL[name].count("product_key as item") == 1 and SQL[f"{name}_brand"].count("brand as item") == 1
    want = con.sql(SQL[name]).fetchall()
    got = [tuple(r) for r in QUERIES[name](spark, data).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert QUERIES[name](spark, data).schema["item_a"].dataType.typeName() == "long"
