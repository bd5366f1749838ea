"""Lists with filters and pages, order views and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.columns import big

STATUSES = ("pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded")
PAGE, MOST = 20, 100


def _contains(term: str, *cols: str):
    """The term, taken literally and without regard to case, in any of the columns."""
    found = F.lit(False)
    for c in cols:
        found = found | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(term.lower())), F.lit(False))
    return found


def list_products(
    dp: DataFrame,
    category: str | None = None,
    active: bool | None = None,
    min_cents: int | None = None,
    max_cents: int | None = None,
    search: str | None = None,
) -> DataFrame:
    """Products that meet every given filter; the search looks into sku, name and brand."""
    rules = [
        (category, lambda: F.col("category_name") == category),
        (active, lambda: F.col("is_current") == active),
        (min_cents, lambda: F.col("base_price_cents") >= min_cents),
        (max_cents, lambda: F.col("base_price_cents") <= max_cents),
        (search, lambda: _contains(search, "product_name", "sku", "brand")),
    ]
    for value, rule in rules:
        dp = dp.where(rule()) if value is not None else dp
    return dp


def list_customers(dc: DataFrame, country: str | None = None, active: bool | None = None, search: str | None = None) -> DataFrame:
    """Customers that meet every given filter; countries compare in upper case."""
    if country is not None:
        dc = dc.where(F.col("country_code") == country.upper())
    if active is not None:
        dc = dc.where(F.col("is_current") == active)
    return dc.where(_contains(search, "email", "customer_name")) if search is not None else dc


def list_orders(oh: DataFrame, dc: DataFrame, status: str | None = None, customer_key: int | None = None) -> DataFrame:
    """Orders with their customer, newest first."""
    if status is not None and status not in STATUSES:
        raise ValueError(f"status must be one of {', '.join(STATUSES)}")
    if status is not None:
        oh = oh.where(F.col("status") == status)
    if customer_key is not None:
        oh = oh.where(F.col("customer_key") == customer_key)
    return (
        oh.join(dc.select("customer_key", "customer_name", "email"), "customer_key")
        .select("order_id", "customer_key", "customer_name", "email", "status", "total_cents", "created_at")
        .orderBy(F.desc("created_at"), "order_id")
    )


def paginate(df: DataFrame, order: list, page: int = 1, limit: int = PAGE) -> DataFrame:
    """One page, with the number of rows and pages of the whole list. ``order`` ends with a key."""
    page, limit = max(1, page), min(max(1, limit), MOST)
    total = df.agg(big(F.count(F.lit(1))).alias("total"))
    rows = df.orderBy(*order).offset((page - 1) * limit).limit(limit)
    return (
        rows.crossJoin(F.broadcast(total))
        .withColumn("pages", F.greatest(F.lit(1), F.ceil(F.col("total") / limit)).cast("bigint"))
        .withColumn("page", F.lit(page).cast("bigint"))
    )


def order_details(fo: DataFrame, dc: DataFrame, dp: DataFrame) -> DataFrame:
    """One flat row per item with its order, customer and product."""
    item = fo.withColumn("line_total_cents", F.col("quantity") * F.col("unit_price_cents"))
    df = item.join(dc.select("customer_key", "email", "customer_name", "country_code"), "customer_key").join(
        dp.select("product_key", "sku", "product_name", "category_name"),
        "product_key",
    )
    return df.select(
        "order_id",
        "order_status",
        "ordered_at",
        "customer_key",
        "email",
        "customer_name",
        "country_code",
        "quantity",
        "unit_price_cents",
        "line_total_cents",
        "product_key",
        "sku",
        "product_name",
        "category_name",
    )


def order_subtotal(oh: DataFrame, fo: DataFrame) -> DataFrame:
    """Sum of line totals per order, 0 without lines. ``oh``: order_id."""
    per = fo.groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("s"))
    return oh.select("order_id").join(per, "order_id", "left").select("order_id", big(F.coalesce("s", F.lit(0))).alias("subtotal_cents"))


def order_document(fo: DataFrame, dp: DataFrame, order_id: int | None = None) -> DataFrame:
    """One row per order with its items as a sorted array; an order has a bounded number of items."""
    item = fo.where(F.col("order_id") == order_id) if order_id is not None else fo
    item = item.join(dp.select("product_key", "sku", "product_name", "category_name"), "product_key")
    return item.groupBy("order_id", "customer_key", "ordered_at").agg(
        F.sort_array(F.collect_list(F.struct("product_key", "sku", "product_name", "category_name", "quantity", "unit_price_cents"))).alias(
            "items",
        ),
    )
