"""Order requests as batches: prices, discounts, rejections, reservations, numbers, updates.

A request: request_id, customer_key, items (array of product_key and quantity, or the same as JSON), discount_code,
shipping_cents, at.
Codes and texts of rejections are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.columns import big
from tradewind.functions.ranks import ROWS_PER_RANGE, carried
from tradewind.operators.warehouse import assign_keys

ITEMS = "array<struct<product_key: bigint, quantity: bigint>>"
STATUSES = ("pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded")


def request_items(requests: DataFrame) -> DataFrame:
    """One row per requested item."""
    items = F.from_json("items", ITEMS) if dict(requests.dtypes)["items"] == "string" else F.col("items")
    return requests.select("request_id", "customer_key", "at", F.explode(items).alias("i")).select(
        "request_id",
        "customer_key",
        "at",
        "i.*",
    )


def assess_items(items: DataFrame, products: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """One row per request that has items, from one pass over them: subtotal_cents at sale or base price (null if no
    product is known), and whether some item has no inventory record (no_record), no active product (inactive) or less
    stock than asked (short)."""
    price = F.coalesce("sale_price_cents", "base_price_cents") if "base_price_cents" in products.columns else F.lit(None).cast("bigint")
    active = F.col("is_active") if "is_active" in products.columns else F.lit(True)
    item = items.join(products.select("product_key", price.alias("price"), active.alias("p")), "product_key", "left")
    any_of = lambda c: F.max(F.coalesce(c, F.lit(False)).cast("int"))
    found = [F.sum(F.col("price") * F.col("quantity")).alias("subtotal_cents"), any_of(~F.coalesce("p", F.lit(False))).alias("inactive")]
    if inventory is not None:
        stock = inventory.groupBy("product_key").agg(F.sum("quantity_available").alias("available"))
        item = item.join(stock, "product_key", "left")
        found += [any_of(F.col("available").isNull()).alias("no_record"), any_of(F.col("available") < F.col("quantity")).alias("short")]
    return item.groupBy("request_id").agg(*found)


def price_orders(
    requests: DataFrame,
    products: DataFrame,
    discounts: DataFrame | None = None,
    tax_rate: float = 0.08,
    assessed: DataFrame | None = None,
) -> DataFrame:
    """Subtotal at sale or base price, discount (``discounts``: request_id, discount_cents), tax on the rest, total.
    ``assessed``: what ``assess_items`` found, where it is stored already."""
    if assessed is None:
        assessed = assess_items(request_items(requests), products)
    sums = assessed.where("subtotal_cents is not null").select("request_id", "subtotal_cents")
    df = requests.select("request_id", "customer_key", F.coalesce("shipping_cents", F.lit(0)).cast("bigint").alias("shipping_cents")).join(
        sums,
        "request_id",
    )
    df = df.join(discounts, "request_id", "left") if discounts is not None else df.withColumn("discount_cents", F.lit(0))
    df = df.withColumn("discount_cents", big(F.coalesce("discount_cents", F.lit(0))))
    df = df.withColumn("tax_cents", F.floor((F.col("subtotal_cents") - F.col("discount_cents")) * F.lit(tax_rate) + 0.5).cast("bigint"))
    return df.withColumn("total_cents", F.col("subtotal_cents") - F.col("discount_cents") + F.col("shipping_cents") + F.col("tax_cents"))


def apply_discounts(priced: DataFrame, codes: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``priced``: request_id, at, discount_code, subtotal_cents, shipping_cents. Adds discount_cents and reason (null:
    applied or no code). Uses are given in request order until the code's maximum is reached; only requests that are
    eligible for a code with a maximum take turns."""
    c = codes.select(
        F.upper("code").alias("code"),
        "discount_type",
        "discount_value",
        "minimum_cents",
        "maximum_uses",
        "current_uses",
        "is_active",
        "valid_from",
        "valid_until",
    )
    priced = priced.withColumn("code", F.upper(F.nullif("discount_code", F.lit(""))))
    df = priced.where("code is not null").join(c, "code", "left")
    valid = F.coalesce(
        F.col("is_active") & (F.col("valid_from") <= F.col("at")) & (F.col("valid_until").isNull() | (F.col("valid_until") > F.col("at"))),
        F.lit(False),
    )
    enough = F.col("subtotal_cents") >= F.coalesce("minimum_cents", F.lit(0))
    percent = F.floor(F.col("subtotal_cents") * F.col("discount_value") / 100 + 0.5)
    fixed = F.least(F.floor(F.col("discount_value") * 100 + 0.5), F.col("subtotal_cents"))
    kind = (
        F.when(F.col("discount_type") == "percentage", percent)
        .when(F.col("discount_type") == "fixed_amount", fixed)
        .when(F.col("discount_type") == "free_shipping", F.col("shipping_cents"))
        .otherwise(0)
    )
    why = F.when(~valid, "P0006").when(~enough, "P0007")
    left = F.col("maximum_uses") - F.coalesce("current_uses", F.lit(0))
    df = df.select(
        "request_id",
        "at",
        "code",
        big(kind).alias("discount_cents"),
        why.alias("reason"),
        F.when(why.isNull(), left).alias("left"),
    )
    turns = carried(df.where("left is not null"), ["code"], ["at", "request_id"], sums={"turn": F.lit(1)}, rows_per_range=rows_per_range)
    turns = turns.withColumn("reason", F.when(F.col("turn") > F.col("left"), "P0008"))
    done = [
        "request_id",
        F.when(F.col("reason").isNull(), F.col("discount_cents")).otherwise(0).cast("bigint").alias("discount_cents"),
        "reason",
    ]
    none = priced.where("code is null").select(
        "request_id",
        F.lit(0).cast("bigint").alias("discount_cents"),
        F.lit(None).cast("string").alias("reason"),
    )
    return df.where("left is null").select(*done).unionByName(turns.select(*done)).unionByName(none)


def order_rejections(
    requests: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    inventory: DataFrame,
    discounts: DataFrame | None = None,
    assessed: DataFrame | None = None,
) -> DataFrame:
    """request_id and the code of the first rule that fails: inactive customer, no items, no inventory record, inactive
    product, too little stock, and what ``apply_discounts`` found. ``assessed``: as in ``price_orders``."""
    known = customers.where("is_active").select("customer_key", F.lit(1).alias("c"))
    per = assess_items(request_items(requests), products, inventory) if assessed is None else assessed
    per = per.select("request_id", F.col("no_record").alias("f3"), F.col("inactive").alias("f4"), F.col("short").alias("f5"))
    df = requests.select("request_id", "customer_key").join(known, "customer_key", "left").join(per, "request_id", "left")
    df = df.join(discounts.select("request_id", "reason"), "request_id", "left") if discounts is not None else df.withColumn(
        "reason",
        F.lit(None).cast("string"),
    )
    code = (
        F.when(F.col("c").isNull(), "P0001")
        .when(F.col("f3").isNull(), "P0002")
        .when(F.col("f3") == 1, "P0003")
        .when(F.col("f4") == 1, "P0004")
        .when(F.col("f5") == 1, "P0005")
        .otherwise(F.col("reason"))
    )
    return df.select("request_id", code.alias("rejected")).where("rejected is not null")


def reserve_stock(items: DataFrame, inventory: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per item, in request order within the product: what is asked so far and whether stock covers it. ``items``:
    request_id, product_key, quantity, at; requests that other rules reject are removed before. Sums run along ranges, so
    a product that all want at once is no task's alone."""
    stock = inventory.groupBy("product_key").agg(F.sum("quantity_available").alias("available"))
    df = carried(items, ["product_key"], ["at", "request_id"], sums={"asked": F.col("quantity")}, rows_per_range=rows_per_range)
    df = df.join(stock, "product_key", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    return df.select(
        "request_id",
        "product_key",
        "quantity",
        big(F.col("asked")).alias("asked"),
        big(F.col("available")).alias("available"),
        (F.col("asked") <= F.col("available")).alias("reserved"),
    )


def loyalty_points(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Points after the batch: one per whole 100 cents of each order."""
    per = orders.groupBy("customer_key").agg(F.sum(F.floor(F.col("total_cents") / 100)).alias("p"))
    return customers.join(per, "customer_key", "left").select(
        "customer_key",
        big(F.coalesce("loyalty_points", F.lit(0)) + F.greatest(F.coalesce("p", F.lit(0)), F.lit(0))).alias("loyalty_points"),
    )


def order_numbers(orders: DataFrame, start: int = 1000) -> DataFrame:
    """ORD-<year>-<eight digits>, consecutive from ``start``, unique over all orders."""
    df = assign_keys(orders, ["order_id"], "seq", start)
    return df.select(
        "order_id",
        F.concat(F.lit("ORD-"), F.year("created_at").cast("string"), F.lit("-"), F.lpad(F.col("seq").cast("string"), 8, "0")).alias(
            "order_number",
        ),
    )


def status_updates(orders: DataFrame, updates: DataFrame) -> DataFrame:
    """Orders with the latest valid update of their status; shipped and delivered are stamped at their first time."""
    ok = updates.where(F.lower("status").isin(*STATUSES)).withColumn("status", F.lower("status"))
    when = lambda s: F.min(F.when(F.col("status") == s, F.col("at")))
    last = ok.groupBy("order_id").agg(
        F.max_by("status", F.struct("at", "status")).alias("new"),
        when("shipped").alias("shipped_at"),
        when("delivered").alias("delivered_at"),
    )
    return orders.join(last, "order_id", "left").select(
        "order_id",
        F.coalesce("new", "status").alias("status"),
        "shipped_at",
        "delivered_at",
    )


def rejected_updates(updates: DataFrame) -> DataFrame:
    """Updates with an unknown status."""
    return updates.where(~F.coalesce(F.lower("status").isin(*STATUSES), F.lit(False)))


def upsert_entities(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    unique: str,
    allowed: list[str],
    required: list[str],
    order: str = "at",
) -> tuple[DataFrame, DataFrame]:
    """(table after the batch, rejected changes with a reason). Only allowed fields change; null leaves a field as it is;
    ``is_active=false`` is a soft delete. New rows need the required fields; a ``unique`` value that another key has is
    a conflict. Of changes to a key at the same ``order`` the largest, field by field, counts."""
    newest = changes.groupBy(key).agg(F.max(F.struct(order, *allowed)).alias("__last"))
    latest = newest.select(key, *[F.col(f"__last.{c}").alias(f"__{c}") for c in allowed])
    df = target.withColumn("__old", F.lit(True)).join(latest.withColumn("__new", F.lit(True)), key, "full_outer")
    for c in allowed:
        df = df.withColumn(c, F.coalesce(f"__{c}", c))
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(c).isNull()
    bad = F.when(F.col("__old").isNull() & lacking, "missing required field")
    # A new or changed value gives way to the row that had it; among new ones the smallest key has it.
    # Rows without a value meet nobody, so each is a partition of its own.
    alone = F.when(F.col(unique).isNull(), F.col(key))
    claims = F.col("__old").isNull() | F.coalesce(F.col(f"__{unique}").isNotNull(), F.lit(False))
    holder = F.first(key).over(Window.partitionBy(unique, alone).orderBy(claims, key))
    taken = F.when(F.col(unique).isNotNull() & F.col("__new") & (holder != F.col(key)), "unique value taken")
    df = df.withColumn("__why", F.coalesce(bad, taken))
    kept = df.where("__why is null").select(*target.columns)
    back = df.where("__why is not null and __old").select(key).join(target, key)
    return kept.unionByName(back.select(*target.columns)), df.where("__why is not null").select(key, F.col("__why").alias("reason"))
