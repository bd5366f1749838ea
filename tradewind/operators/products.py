"""Product analytics: baskets, similarity, returns, stock.

``fo``: fact_orders (one row per item), ``dp``: current products, ``inv``: inventory. ``as_of=None``: the newest day.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.columns import NOT_SOLD, big, money, n_distinct, n_where, ratio, rounded, sold, with_as_of
from tradewind.functions.store import discard, save


def snapshot_inventory(inv: DataFrame, dp: DataFrame, day: str) -> DataFrame:
    """Stock per product and warehouse on a day, with its value."""
    own = inv.join(dp.select("product_key", "category_name"), "product_key")
    return own.select(
        F.lit(day).cast("date").alias("snapshot_date"),
        "product_key",
        "warehouse_id",
        "category_name",
        "quantity_on_hand",
        "quantity_reserved",
        (F.col("quantity_on_hand") - F.col("quantity_reserved")).alias("quantity_available"),
        "reorder_point",
        "unit_cost_cents",
        (F.col("quantity_on_hand") * F.col("unit_cost_cents")).alias("inventory_value_cents"),
    )


def inventory_turnover(
    fo: DataFrame,
    snapshots: DataFrame,
    dp: DataFrame,
    as_of: str | None = None,
    months: int = 12,
    cogs: float = 0.6,
) -> DataFrame:
    """Cost of goods of the last months over the mean stock value, by category."""
    recent = with_as_of(fo, as_of, "order_date").where(F.col("order_date") >= F.add_months("as_of", -months))
    per = sold(recent).groupBy("product_key").agg(F.sum("quantity").alias("units"))
    cost = (
        per.join(dp, "product_key")
        .groupBy("category_name")
        .agg((F.sum(F.col("units") * F.col("base_price_cents")).cast("double") * cogs).alias("cogs"))
    )
    stock = snapshots.groupBy("category_name").agg(F.avg("inventory_value_cents").alias("stock"))
    turn = F.col("cogs") / F.nullif(F.col("stock"), F.lit(0.0))
    return cost.join(stock, "category_name").select(
        "category_name",
        money(F.col("cogs")).alias("annual_cogs"),
        money(F.col("stock")).alias("avg_inventory_value"),
        rounded(turn, 2).alias("inventory_turnover_ratio"),
        rounded(F.lit(365.0) / F.nullif(turn, F.lit(0.0)), 1).alias("days_sales_of_inventory"),
    )


def basket_pairs(fo: DataFrame, dp: DataFrame, level: str = "product_key", min_count: int = 10, limit: int = 100) -> DataFrame:
    """Pairs bought in one order, with support, confidence and lift; the best ``limit`` by lift. ``level``: product_key,
    or a coarser column of ``dp``.

    Pairs grow with the square of an order's items, and an order has few; items that reach ``min_count`` orders alone
    can be in a pair that does, so the others leave before pairs are made.
    """
    items = (
        sold(fo)
        .join(dp.select("product_key", *{level} - {"product_key"}), "product_key")
        .select("order_id", F.col(level).alias("item"))
        .distinct()
    )
    totals = items.groupBy("item").agg(big(F.count(F.lit(1))).alias("n"))
    every = items.agg(n_distinct("order_id").alias("every"))
    often = items.join(totals.where(F.col("n") >= min_count).select("item"), "item", "left_semi")
    a, b = often.select("order_id", F.col("item").alias("a")), often.select("order_id", F.col("item").alias("b"))
    pairs = (
        a.join(b, "order_id")
        .where("a < b")
        .groupBy("a", "b")
        .agg(big(F.count(F.lit(1))).alias("both"))
        .where(F.col("both") >= min_count)
    )
    df = (
        pairs.join(totals.select(F.col("item").alias("a"), F.col("n").alias("na")), "a")
        .join(totals.select(F.col("item").alias("b"), F.col("n").alias("nb")), "b")
        .crossJoin(F.broadcast(every))
    )
    both, na, nb, n = (F.col(c).cast("double") for c in ("both", "na", "nb", "every"))
    out = df.select(
        F.col("a").alias("item_a"),
        F.col("b").alias("item_b"),
        F.col("both").alias("co_purchase_count"),
        F.col("na").alias("orders_a"),
        F.col("nb").alias("orders_b"),
        ratio(both, n, 3).alias("support_pct"),
        ratio(both, na, 1).alias("confidence_a_to_b_pct"),
        rounded(both * n / (na * nb), 2).alias("lift"),
    )
    return out.orderBy(F.desc("lift"), F.desc("co_purchase_count"), "item_a", "item_b").limit(limit)


def tiled_pairs(df: DataFrame, group: str, item: str, value: str, tile: int, part: str | None = None, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """a, b, va, vb: all pairs a < b of the items of each group, with their values. ``part``: a boolean column of ``df``;
    only pairs with an item where it is true. ``turn``: i, n; the i-th (from 0) of n shares of the pairs, all rows of a pair in one.

    A group's items are dealt into g blocks of about ``tile``, and each two blocks meet under a key of their own: g (g + 1) / 2
    tasks of at most tile^2 pairs for a large group, one for a small one; an item is sent g times. Where no group has
    over ``tile`` items, all is one plain join. ``df`` is read more than once; an item is expected once in a group."""
    blocks = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("__g"))
    up = F.col("__x") < F.col("__y")
    pick = lambda x, y: F.when(up, F.col(x)).otherwise(F.col(y))
    now = lambda c: F.lit(True) if turn[1] == 1 else F.pmod(F.xxhash64(c), F.lit(turn[1])) == turn[0]
    out = [pick("__x", "__y").alias("a"), pick("__y", "__x").alias("b"), pick("__vx", "__vy").alias("va"), pick("__vy", "__vx").alias("vb")]
    df = df.select(group, item, value, (F.lit(True) if part is None else F.col(part)).alias("__in"))
    x = [F.col(item).alias("__x"), F.col(value).alias("__vx"), F.col("__in").alias("__ix")]
    y = [F.col(item).alias("__y"), F.col(value).alias("__vy"), F.col("__in").alias("__iy")]
    if blocks.where("__g > 1").isEmpty():
        # The left item of a pair is the same in every group.
        met = df.where("__in").select(group, *x).where(now("__x")).join(df.select(group, *y), group)
        return met.where(up if part is None else up | (~F.col("__iy") & (F.col("__x") > F.col("__y")))).select(*out)
    # A group's rows are many only where it is large: the join goes by size and splits it.
    df = df.join(blocks, group).withColumn("__block", F.pmod(F.xxhash64(item), F.col("__g")).cast("int"))
    left = df.select(group, *x, F.col("__block").alias("__i"), F.explode(F.sequence(F.col("__block"), F.col("__g") - 1)).alias("__j"))
    right = df.select(group, *y, F.explode(F.sequence(F.lit(0), F.col("__block"))).alias("__i"), F.col("__block").alias("__j"))
    met = left.join(right, [group, "__i", "__j"]).where((F.col("__i") < F.col("__j")) | up)
    return met.where((F.col("__ix") | F.col("__iy")) & now(F.least("__x", "__y"))).select(*out)


#: The groups of customers are taken in so many turns at most, as the keys of one turn are on the disks at once.
ROUNDS = 4


def sparse_pairs(share: DataFrame, items: DataFrame, min_common: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """For items of few customers, pairs that have ``min_common`` in common, found without making every pair of a basket.

    Customers fall into ``min_common`` - 1 groups, so of ``min_common`` common customers two are in one group: such two
    customers are a key, and items that no other shares a key with are done. The pairs of items under a key are held
    against each other's lists of customers, as 32-bit numbers of which equal ones are allowed for; what may reach
    ``min_common`` is looked up. ``share``: customer_key, item, s; ``items``: item, n, baskets (the other items in its
    customers' baskets, added up). Returns the pairs a, b, va, vb per common customer, and the items whose pairs under
    keys would take more room than those of the baskets; they are left to the plain way."""
    groups = min_common - 1
    # A key is rebuilt from the list; lists are short, as items with more pairs of customers than of basket items are not here.
    held = save(
        share.join(items.select("item"), "item").groupBy("item").agg(F.sort_array(F.collect_list("customer_key")).alias("customers")),
        "held",
        clean=True,
    )
    kept, rounds = [], min(groups, ROUNDS)
    for first in range(rounds):
        own = held.select("*", F.explode(F.sequence(F.lit(first), F.lit(groups - 1), F.lit(rounds))).alias("group"))
        own = own.select("item", F.filter("customers", lambda c: F.pmod(F.xxhash64(c), F.lit(groups)) == F.col("group")).alias("c")).where(F.size("c") > 1)
        two = own.select("item", "c", F.posexplode("c").alias("i", "x")).where(F.col("i") + 1 < F.size("c"))
        two = two.select("item", "x", F.explode(F.slice("c", F.col("i") + 2, F.size("c"))).alias("y"))
        # 48 bits: two keys as one add a pair that is ruled out later, and take less room.
        keys = two.select(F.shiftrightunsigned(F.xxhash64("x", "y"), 16).alias("key"), "item")
        met = keys.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where(F.col("n") > 1)
        kept.append(save(met, "keys", clean=True))
    both = reduce(DataFrame.unionByName, kept)
    under = both.groupBy("item").agg(F.sum(F.col("n") - 1).alias("pairs"))
    # A pair from a basket takes some 24 bytes, one under a key those and 4 for each customer of a list.
    dear = F.col("pairs") * (F.col("n") + 6) > F.col("baskets") * 6
    back = save(under.join(items, "item").where(dear).select("item"), "back", clean=True)
    if not back.isEmpty():
        both = both.join(back, "item", "left_anti")
    pairs = tiled_pairs(both, "key", "item", "n", tile).select("a", "b").distinct()
    short = lambda c: F.transform(c, lambda x: F.hash(x))
    of = lambda i, c: held.select(F.col("item").alias(i), F.col("customers").alias(c))
    left = pairs.join(of("a", "ca"), "a").select("a", "b", short(F.col("ca")).alias("ha"))
    met = left.join(of("b", "cb"), "b")
    twice = F.size("ha") - F.size(F.array_distinct("ha"))
    near = met.where(F.size(F.array_intersect("ha", short(F.col("cb")))) + twice >= min_common)
    near = near.select("a", "b", F.explode(F.filter("cb", lambda c: F.array_contains(F.col("ha"), F.hash(c)))).alias("customer_key"))
    near = save(near, "near", clean=True)
    discard(held, *kept)
    # Few pairs are left in most tables, so the shares they need are picked by a scan.
    asked = near.select(F.col("a").alias("item"), "customer_key").unionByName(near.select(F.col("b").alias("item"), "customer_key")).distinct()
    own = share.join(asked, ["item", "customer_key"], "left_semi")
    of = lambda i, v: own.select(F.col("item").alias(i), "customer_key", F.col("s").alias(v))
    return near.join(of("a", "va"), ["a", "customer_key"]).join(of("b", "vb"), ["b", "customer_key"]).select("a", "b", "va", "vb"), back


def _counted(pairs: DataFrame, min_common: int) -> DataFrame:
    """Pairs with enough rows, and the sums of their products."""
    return (
        pairs.groupBy("a", "b")
        .agg(
            big(F.count(F.lit(1))).alias("common"),
            F.sum(F.col("va") * F.col("vb")).alias("dot"),
            F.sum(F.col("va") * F.col("va")).alias("aa"),
            F.sum(F.col("vb") * F.col("vb")).alias("bb"),
        )
        .where(F.col("common") >= min_common)
    )


def item_similarity(
    fo: DataFrame,
    dp: DataFrame,
    level: str = "product_key",
    min_common: int = 5,
    min_cos: float = 0.1,
    limit: int = 200,
    norms: str = "common",
    tile: int = 512,
    most: int = 50_000_000,
) -> DataFrame:
    """Cosine of customer-normalised quantities; rank within the first item. ``norms``: ``common`` takes the lengths over
    the two items' common customers only, ``all`` over all customers of each item.

    An item needs ``min_common`` customers to have as many in common with another; the others leave before pairs are made.
    Pairs of items that have few customers each are found by pairs of customers; pairs with an item whose customers are
    many against their baskets are made basket by basket, in turns of about ``most`` pairs, or twice the rows of items and
    customers where that is more, so that disks hold one turn. Customers with many items are cut into tiles.
    """
    if norms not in ("common", "all"):
        raise ValueError("norms must be common or all")
    q = (
        sold(fo)
        .join(dp.select("product_key", *{level} - {"product_key"}), "product_key")
        .groupBy("customer_key", F.col(level).alias("item"))
        .agg(F.sum("quantity").alias("q"))
    )
    q = save(q, "units", clean=True)
    # Whole-number weights: shares of a customer's units in millionths, so that sums do not depend on their order.
    units = q.groupBy("customer_key").agg(F.sum("q").alias("units"), F.count(F.lit(1)).alias("basket"))
    s = F.floor(F.col("q") * 1_000_000 / F.col("units")).cast("bigint").alias("s")
    share = save(q.join(units, "customer_key").select("customer_key", "item", s, "basket").where("s > 0"), "shares", clean=True)
    discard(q)
    lengths = share.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum(F.col("basket") - 1).alias("baskets"))
    n = F.col("n")
    few = n * (n - 1) <= F.col("baskets") * (min_common - 1) if min_common > 1 else F.lit(False)
    lengths = save(lengths.where(n >= min_common).withColumn("few", few), "items", clean=True)
    share = share.select("customer_key", "item", "s")
    many, counted = lengths.where("not few").select("item"), []
    if not lengths.where("few").isEmpty():
        found, back = sparse_pairs(share, lengths.where("few"), min_common, tile)
        many = many.unionByName(back)
        counted.append(_counted(found, min_common))
    if not many.isEmpty() or not counted:
        many = many.withColumn("many", F.lit(True))
        often = share.join(lengths.select("item"), "item").join(many, "item", "left").withColumn("many", F.coalesce("many", F.lit(False)))
        sums = lengths.join(many, "item", "left").agg(F.sum(F.when(F.col("many"), F.col("baskets"))), F.count("many"), F.count(F.lit(1)), F.sum("n")).first()
        pairs, some, every, rows = (x or 0 for x in sums)
        # Tasks add up their own rows of a pair first, so few items make few rows.
        dealt = min(pairs, some * every * int(share.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        turns = max(1, ceil(dealt / max(most, 2 * rows)))
        often = often if turns == 1 else save(often, "often", clean=True)
        for i in range(turns):
            part = _counted(tiled_pairs(often, "customer_key", "item", "s", tile, "many", (i, turns)), min_common)
            counted.append(part if turns == 1 else save(part, "pairs", clean=True))
    per = reduce(DataFrame.unionByName, counted)
    if norms == "all":
        of = lambda i, n: lengths.select(F.col("item").alias(i), F.col("ss").alias(n))
        per = per.drop("aa", "bb").join(of("a", "aa"), "a").join(of("b", "bb"), "b")
    cos = rounded(F.col("dot").cast("double") / (F.sqrt(F.col("aa").cast("double")) * F.sqrt(F.col("bb").cast("double"))), 4)
    per = per.select("a", "b", "common", cos.alias("cos")).where(F.col("cos") > min_cos)
    out = per.select(
        F.col("a").alias("item_a"),
        F.col("b").alias("item_b"),
        F.col("common").alias("common_customers"),
        F.col("cos").alias("cosine_similarity"),
        big(F.rank().over(Window.partitionBy("a").orderBy(F.desc("cos")))).alias("similarity_rank"),
    )
    return out.orderBy(F.desc("cosine_similarity"), "item_a", "item_b").limit(limit)


def return_rates(fo: DataFrame, dp: DataFrame, min_orders: int = 10, limit: int = 50) -> DataFrame:
    """Refunded orders and money of products with enough orders: one pass over the facts."""
    back = F.col("order_status").isin("refunded", "partially_refunded")
    order = sold(fo).groupBy("order_id", "product_key").agg(
        F.sum("total_cents").alias("t"),
        F.sum(F.when(back, F.col("total_cents"))).alias("rt"),
        F.max(F.when(back, 1).otherwise(0)).alias("r"),
    )
    per = order.groupBy("product_key").agg(
        big(F.count(F.lit(1))).alias("n"),
        F.sum("r").alias("r"),
        F.sum("t").alias("t"),
        F.coalesce(F.sum("rt"), F.lit(0)).alias("rt"),
    )
    per = per.where(F.col("n") >= min_orders)
    out = per.join(dp.select("product_key", "product_name", "category_name", "brand"), "product_key").select(
        "product_key",
        "product_name",
        "category_name",
        "brand",
        F.col("n").alias("total_orders"),
        F.col("r").alias("returned_orders"),
        ratio(F.col("r"), F.col("n"), 2).alias("return_rate_pct"),
        money(F.col("t")).alias("total_revenue"),
        money(F.col("rt")).alias("total_refunded"),
        ratio(F.col("rt"), F.col("t"), 2).alias("refund_rate_pct"),
    )
    return out.orderBy(F.desc("return_rate_pct"), F.desc("total_orders"), "product_key").limit(limit)


def top_products(fo: DataFrame, dp: DataFrame, inv: DataFrame, n: int = 10) -> DataFrame:
    """Products with most revenue, with margin over unit cost."""
    per = (
        sold(fo, NOT_SOLD)
        .groupBy("product_key")
        .agg(
            F.sum("quantity").alias("units_sold"),
            F.sum("total_cents").alias("cents"),
            n_distinct("customer_key").alias("unique_customers"),
        )
    )
    df = per.join(dp.select("product_key", "sku", "product_name", "category_name"), "product_key").join(
        inv.select("product_key", "unit_cost_cents"),
        "product_key",
    )
    cost = F.col("units_sold") * F.col("unit_cost_cents")
    return (
        df.orderBy(F.desc("cents"), "product_key")
        .limit(n)
        .select(
            "sku",
            "product_name",
            "category_name",
            "units_sold",
            money(F.col("cents")).alias("total_revenue"),
            money(cost).alias("total_cost"),
            ratio(F.col("cents") - cost, F.col("cents"), 1).alias("gross_margin_pct"),
            "unique_customers",
        )
    )


def inventory_health(snapshots: DataFrame, overstock: int = 10) -> DataFrame:
    """Latest snapshot by category: out of stock, low, overstocked."""
    last = snapshots.crossJoin(F.broadcast(snapshots.agg(F.max("snapshot_date").alias("last")))).where(
        F.col("snapshot_date") == F.col("last"),
    )
    on, at = F.col("quantity_on_hand"), F.col("reorder_point")
    return last.groupBy("category_name").agg(
        big(F.count(F.lit(1))).alias("sku_count"),
        n_where(on == 0).alias("out_of_stock"),
        n_where((on <= at) & (on > 0)).alias("low_stock"),
        n_where(on > at * overstock).alias("overstocked"),
        rounded(F.avg(on)).alias("avg_qty_on_hand"),
    )


def inventory_status(inv: DataFrame, dp: DataFrame, fo: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    """Stock status, and days of stock at the pace of the last days."""
    recent = sold(with_as_of(fo, as_of, "order_date").where(F.datediff("as_of", "order_date") < days))
    pace = recent.groupBy("product_key").agg(rounded(F.sum("quantity") / float(days), 2).alias("pace"))
    have = F.col("quantity_on_hand") - F.col("quantity_reserved")
    df = inv.join(dp.select("product_key", "sku", "product_name", "category_name", "base_price_cents"), "product_key").join(
        pace,
        "product_key",
        "left",
    )
    return df.select(
        "product_key",
        "sku",
        "product_name",
        "category_name",
        "base_price_cents",
        "warehouse_id",
        "quantity_on_hand",
        "quantity_reserved",
        have.alias("quantity_available"),
        "reorder_point",
        F.when(have <= 0, "out_of_stock").when(have <= F.col("reorder_point"), "low_stock").otherwise("in_stock").alias("stock_status"),
        big(F.when(F.col("pace") > 0, rounded(have / F.col("pace")))).alias("days_of_stock"),
    )


def product_performance(dp: DataFrame, fo: DataFrame, fe: DataFrame, as_of: str | None = None, days: int = 90) -> DataFrame:
    """Sales, returns and 90 days of views and cart additions per product, also those never sold."""
    paid = F.col("payment_status").isin("captured", "partially_refunded", "refunded")
    back = F.col("order_status").isin("refunded", "partially_refunded")
    order = sold(fo).where(paid).groupBy("order_id", "customer_key", "product_key").agg(
        F.sum("quantity").alias("units"),
        F.sum("total_cents").alias("cents"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
        F.max(F.when(back, 1).otherwise(0)).alias("back"),
    )
    sales = order.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("orders"),
        n_distinct("customer_key").alias("customers"),
        F.min("first").alias("first_sale_date"),
        F.max("last").alias("last_sale_date"),
        *[F.sum(c).alias(c) for c in ("units", "cents", "back")],
    )
    seen = (
        with_as_of(fe, as_of, "occurred_at")
        .where(F.datediff("as_of", "event_date") < days)
        .groupBy("product_key")
        .agg(n_where(F.col("event_type") == "product_view").alias("views"), n_where(F.col("event_type") == "add_to_cart").alias("carts"))
    )
    df = dp.join(sales, "product_key", "left").join(seen, "product_key", "left")
    zero = lambda c: big(F.coalesce(c, F.lit(0)))
    return df.select(
        "product_key",
        "sku",
        "product_name",
        "category_name",
        "base_price_cents",
        zero("units").alias("units_sold"),
        zero("orders").alias("order_count"),
        zero("cents").alias("revenue_cents"),
        zero("customers").alias("unique_customers"),
        "first_sale_date",
        "last_sale_date",
        ratio(F.col("back"), F.col("orders"), 2).alias("return_rate_pct"),
        ratio(zero("orders"), F.col("carts"), 2).alias("cart_conversion_rate_pct"),
        zero("views").alias("views_90d"),
        zero("carts").alias("cart_adds_90d"),
    )


def low_stock(inv: DataFrame, dp: DataFrame, threshold: int = 10) -> DataFrame:
    """Active products with little stock, least first."""
    df = inv.where(F.col("quantity_on_hand") <= threshold).join(dp.where("is_current"), "product_key")
    return df.select(
        "product_key",
        "sku",
        "product_name",
        "category_name",
        F.col("quantity_on_hand").alias("stock_qty"),
        "base_price_cents",
    ).orderBy("stock_qty", "product_key")


def product_rating(reviews: DataFrame, dp: DataFrame) -> DataFrame:
    """Published reviews per product: number and mean with two digits; products without any have 0 and null."""
    per = reviews.where("status = 'published'").groupBy("product_key").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("mean"))
    return dp.join(per, "product_key", "left").select(
        "product_key",
        big(F.coalesce("n", F.lit(0))).alias("review_count"),
        rounded(F.col("mean"), 2).alias("avg_rating"),
    )


def price_history(versions: DataFrame) -> DataFrame:
    """Price changes of each product: old, new, since when. ``versions``: product_key, price_cents, effective_from."""
    before = F.lag("price_cents").over(Window.partitionBy("product_key").orderBy("effective_from", "price_cents"))
    return (
        versions.withColumn("old_price_cents", before)
        .where(~F.col("price_cents").eqNullSafe(F.col("old_price_cents")) & F.col("old_price_cents").isNotNull())
        .select("product_key", "old_price_cents", F.col("price_cents").alias("new_price_cents"), "effective_from")
    )
