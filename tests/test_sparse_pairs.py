"""Similar items without every pair of a basket: the same pairs, fewer rows dealt out, and nothing left on the disks."""

import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewind.functions.store import CLEAN, save
from tradewind.operators import products


def facts(spark, bought):
    """``bought``: customer, product, quantity."""
    data = [(i, c, p, "delivered", n, date(2024, 1, 1)) for i, (c, p, n) in enumerate(bought)]
    return spark.createDataFrame(data, "order_id long, customer_key long, product_key long, order_status string, quantity long, order_date date")


def similar(bought, min_common, norms, min_cos=0.1):
    """All pairs by brute force."""
    q, total, has = {}, {}, {}
    for c, p, n in bought:
        q[c, p], total[c] = q.get((c, p), 0) + n, total.get(c, 0) + n
    share = {k: n * 1_000_000 // total[k[0]] for k, n in q.items()}
    for (c, p), s in share.items():
        if s:
            has.setdefault(p, {})[c] = s
    out = {}
    for a in has:
        for b in has:
            both = has[a].keys() & has[b].keys() if a < b else ()
            if len(both) >= min_common:
                x, y = (has[a], has[b]) if norms == "all" else ({c: has[a][c] for c in both}, {c: has[b][c] for c in both})
                cos = sum(has[a][c] * has[b][c] for c in both) / (sum(v * v for v in x.values()) ** 0.5 * sum(v * v for v in y.values()) ** 0.5)
                if cos > min_cos + 1e-4:
                    out[a, b] = (len(both), cos)
    return out


def mixed(seed):
    """Products of few customers, best-sellers, and customers who all bought the same."""
    rng = random.Random(seed)
    bought = [(c, rng.randrange(300), rng.randint(1, 9)) for c in range(120) for _ in range(20)]
    bought += [(c, 1000 + p, rng.randint(1, 9)) for c in range(120) for p in range(4) if rng.random() < 0.8]
    bought += [(500 + c, 2000 + p, rng.randint(1, 9)) for c in range(30) for p in range(20)]
    return bought


def parts_of(spark, bought):
    return spark.createDataFrame([(p,) for p in sorted({p for _, p, _ in bought})], "product_key long")


def stages(spark):
    """Rows that each stage so far has written for a shuffle."""
    sc = spark.sparkContext
    found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}


def dealt(spark):
    return sum(stages(spark).values())


@pytest.mark.parametrize("min_common", [1, 2, 5, 8])
@pytest.mark.parametrize("norms", ["common", "all"])
@pytest.mark.parametrize("tile", [512, 7])
def test_all_pairs_are_found(spark, min_common, norms, tile):
    bought = mixed(min_common)
    want = similar(bought, min_common, norms)
    out = products.item_similarity(facts(spark, bought), parts_of(spark, bought), min_common=min_common, norms=norms, limit=10**6, tile=tile)
    got = {(r.item_a, r.item_b): (r.common_customers, r.cosine_similarity) for r in out.collect() if r.cosine_similarity > 0.1002}
    assert {k for k in want if want[k][1] > 0.1003} <= got.keys() <= want.keys() and len(got) > 100
    assert all(n == want[k][0] and cos == pytest.approx(want[k][1], abs=2e-4) for k, (n, cos) in got.items())


def test_each_way_is_taken(spark):
    bought = mixed(5)
    share = facts(spark, bought).groupBy("customer_key", F.col("product_key").alias("item")).agg(F.sum("quantity").alias("s"))
    size = share.groupBy("customer_key").agg(F.count(F.lit(1)).alias("basket"))
    items = share.join(size, "customer_key").groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("basket") - 1).alias("baskets"))
    found, back = products.sparse_pairs(share, items.where("n >= 5"), 5, 512)
    # Customers who all bought the same are no keys to few pairs.
    back = {r.item for r in back.collect()}
    assert back and set(range(2000, 2020)) <= back
    has = {}
    for c, p, _ in bought:
        has.setdefault(p, set()).add(c)
    want = {(a, b) for a in has for b in has if a < b and not {a, b} & back and len(has[a] & has[b]) >= 5}
    assert want and want <= {(r.a, r.b) for r in found.collect()}


@pytest.mark.parametrize("norms", ["common", "all"])
def test_baskets_are_not_paired_out(spark, norms):
    rng = random.Random(9)
    bought = [(c, p, 1) for c in range(600) for p in rng.sample(range(1500), 40)]
    pairs = 600 * 40 * 39 // 2
    before = dealt(spark)
    out = products.item_similarity(facts(spark, bought), parts_of(spark, bought), norms=norms, limit=10**6)
    got = {(r.item_a, r.item_b) for r in out.collect()}
    assert got == set(similar(bought, 5, norms))
    assert dealt(spark) - before < pairs * 0.7


@pytest.mark.parametrize("tile", [512, 7])
def test_pairs_of_baskets_go_in_turns(spark, tile):
    rng = random.Random(11)
    bought = [(c, p, rng.randint(1, 9)) for c in range(2000) for p in rng.sample(range(333), 10)]
    fo, dp, out, largest = facts(spark, bought), parts_of(spark, bought), [], []
    for most in (10**9, 1):
        before = stages(spark).keys()
        df = products.item_similarity(fo, dp, min_common=3, min_cos=0.0, limit=10**6, tile=tile, most=most)
        out.append({tuple(r) for r in df.collect()})
        largest.append(max(n for i, n in stages(spark).items() if i not in before))
    assert out[0] == out[1] and {(r[0], r[1]) for r in out[0]} == set(similar(bought, 3, "common", 0.0))
    assert tile < 512 or largest[1] < 0.6 * largest[0]


def test_a_saved_table_leaves_no_shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def written():
        found = blocks.getAllFiles()
        return {x for x in (found.apply(i).getName() for i in range(found.size())) if x.startswith("shuffle_") and x.endswith(".data")}

    before, own = written(), spark.conf.get(CLEAN, None)
    df = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(4, "k").groupBy("k").count()
    kept = save(df, "kept", clean=True)
    until = time.time() + 10
    while written() - before and time.time() < until:
        time.sleep(0.2)
    assert not written() - before and spark.conf.get(CLEAN, None) == own
    assert kept.count() == 1000 and df.count() == 1000
