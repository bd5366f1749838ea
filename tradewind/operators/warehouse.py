"""Warehouse load: dimension history, facts, keys, snapshots, watermarks.

History rows are valid from ``effective_from`` (inclusive) to ``effective_to`` (exclusive; null: still valid).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.clean import row_hash
from tradewind.functions.columns import big
from tradewind.functions.ranks import ROWS_PER_RANGE, carried, numbered


def scd2_diff(source: DataFrame, current: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Keys with ``change``: new, changed, unchanged. Rows that only the dimension has are left alone and not listed."""
    new = source.select(*keys, row_hash(tracked).alias("__new"))
    old = current.where("is_current").select(*keys, row_hash(tracked).alias("__old"))
    change = F.when(F.col("__old").isNull(), "new").when(F.col("__old") != F.col("__new"), "changed").otherwise("unchanged")
    return new.join(old, keys, "left").select(*keys, change.alias("change"))


def scd2_counts(diff: DataFrame) -> DataFrame:
    """Rows by kind of change."""
    return diff.groupBy("change").agg(big(F.count(F.lit(1))).alias("n"))


#: When a row of a history table was made, and last changed.
AUDIT = ("dw_created_at", "dw_updated_at")


def scd2_apply(dim: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], as_of: str, now: str | None = None) -> DataFrame:
    """The dimension after the load: changed rows end on ``as_of``, new and changed rows begin there. The result is
    written as a new version of the table; it is never written over what it reads.

    ``now``: the time of the load; then rows that begin or end carry it in ``dw_updated_at``, those that begin also in
    ``dw_created_at``, and the others keep theirs (null where the table had none)."""
    if now is not None:
        lacks = [c for c in AUDIT if c not in dim.columns]
        dim = dim.withColumns({c: F.lit(None).cast("timestamp") for c in lacks})
    diff = scd2_diff(source, dim, keys, tracked)
    day = F.lit(as_of).cast("date")
    touched = diff.where("change <> 'unchanged'")
    ended = dim.join(touched.where("change = 'changed'").select(*keys, F.lit(True).alias("__ends")), keys, "left")
    ends = F.col("is_current") & F.coalesce("__ends", F.lit(False))
    kept = (
        ended.withColumn("effective_to", F.when(ends, day).otherwise(F.col("effective_to")))
        .withColumn("is_current", F.col("is_current") & ~ends)
    )
    at = F.lit(now).cast("timestamp")
    if now is not None:
        kept = kept.withColumn(AUDIT[1], F.when(F.coalesce("__ends", F.lit(False)), at).otherwise(F.col(AUDIT[1])))
    begun = (
        source.join(touched.select(*keys), keys, "left_semi")
        .select(*[c for c in source.columns if c in dim.columns])
        .withColumns({"effective_from": day, "effective_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    )
    if now is not None:
        begun = begun.withColumns(dict.fromkeys(AUDIT, at))
    return kept.select(*dim.columns).unionByName(begun, allowMissingColumns=True)


def map_fact_orders(orders: DataFrame, dim_c: DataFrame, dim_p: DataFrame, dim_d: DataFrame) -> DataFrame:
    """Fact rows with current keys; rows without a known customer or product drop out, rows without a date stay."""
    c = dim_c.where("is_current").select(F.col("customer_id"), F.col("customer_key"))
    p = dim_p.where("is_current").select(F.col("product_id"), F.col("product_key"))
    d = dim_d.select(F.col("full_date").alias("order_date"), F.col("date_key").alias("order_date_key"))
    return orders.join(c, "customer_id").join(p, "product_id").join(F.broadcast(d), "order_date", "left").drop("customer_id", "product_id")


def one_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest, column by column, so that a repeated run takes the same."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("__row"))
        .select(*[F.col(f"__row.{c}").alias(c) if c in rest else c for c in df.columns])
    )


def append_new(df: DataFrame, target: DataFrame, key: str, lookback_hours: int | None = None, now: str | None = None) -> DataFrame:
    """Rows to append: one per key, without keys that the target has (of the last hours only, where given). Of several
    rows of a key the smallest, column by column, is taken."""
    if lookback_hours is not None:
        target = target.where(F.col("dw_loaded_at") >= F.lit(now).cast("timestamp") - F.make_interval(hours=F.lit(lookback_hours)))
    return one_each(df, [key]).join(target.select(key), key, "left_anti")


def insert_ignore(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Target and the rows whose keys it lacks, one per key (the smallest, column by column)."""
    return target.unionByName(one_each(df, keys).join(target.select(*keys), keys, "left_anti"))


def assign_keys(df: DataFrame, order: list[str], name: str, start: int = 1, existing: DataFrame | None = None) -> DataFrame:
    """Consecutive keys in the order of the (unique) natural key, from ``start`` or, where a table that has keys already
    is given, from the one after its largest. No task sorts everything."""
    if existing is not None:
        start = max(start, (existing.agg(F.max(name)).first()[0] or 0) + 1)
    return numbered(df, order, name, start)


def as_of_join(fact: DataFrame, dim: DataFrame, key: str, day: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Facts with the dimension row valid on their day: of the key's versions that began by then the last, if it has not
    ended. Versions of a key do not overlap; of several that begin on a day the one that ends last counts.

    Versions and facts are one sequence in order of time, along which the last version is carried forward: no version
    meets a fact that is not its own, and a key with a long history spreads over ranges."""
    mine, theirs = fact.columns, [c for c in dim.columns if c != key]
    version = F.struct(*theirs)
    versions = dim.where(F.col(key).isNotNull() & F.col("effective_from").isNotNull()).select(
        F.col(key).alias("__k"),
        F.col("effective_from").cast("timestamp").alias("__t"),
        F.lit(0).alias("__kind"),
        F.coalesce(F.col("effective_to").cast("timestamp"), F.lit("9999-12-31").cast("timestamp")).alias("__end"),
        version.alias("__version"),
        F.lit(None).cast(fact.select(F.struct(*mine)).schema[0].dataType).alias("__fact"),
    )
    facts = fact.select(
        F.col(key).alias("__k"),
        F.col(day).cast("timestamp").alias("__t"),
        F.lit(1).alias("__kind"),
        F.lit(None).cast("timestamp").alias("__end"),
        F.lit(None).cast(dim.select(version).schema[0].dataType).alias("__version"),
        F.struct(*mine).alias("__fact"),
    )
    found = carried(versions.unionByName(facts), ["__k"], ["__t", "__kind", "__end"], lasts={"__valid": F.col("__version")}, rows_per_range=rows_per_range)
    open_ = F.col("__valid.effective_to").isNull() | (F.col(f"__fact.{day}") < F.col("__valid.effective_to"))
    rows = found.where("__kind = 1").withColumn("__valid", F.when(open_ & F.col("__t").isNotNull(), F.col("__valid")))
    return rows.select("__fact.*", *[F.col(f"__valid.{c}").alias(c) for c in theirs])


def map_fact_events(events: DataFrame, sessions: DataFrame, dim_c: DataFrame, dim_p: DataFrame) -> DataFrame:
    """Event facts: date key, nullable customer and product keys, session attributes."""
    c, p = dim_c.select("customer_key", F.lit(1).alias("__c")), dim_p.select("product_key", F.lit(1).alias("__p"))
    df = events.join(sessions, "session_id", "left").join(c, "customer_key", "left").join(p, "product_key", "left")
    return df.select(
        "event_id",
        F.date_format("occurred_at", "yyyyMMdd").cast("bigint").alias("event_date_key"),
        F.when(F.col("__c") == 1, F.col("customer_key")).alias("customer_key"),
        F.when(F.col("__p") == 1, F.col("product_key")).alias("product_key"),
        "session_id",
        "event_type",
        "occurred_at",
        *[c for c in sessions.columns if c != "session_id"],
    )


def geo_dim(dc: DataFrame, start: int = 1, existing: DataFrame | None = None) -> DataFrame:
    """Distinct country, state, city with keys; ``existing``: places that have theirs already, which keep them."""
    places = dc.select("country_code", "state_province", "city").distinct()
    if existing is None:
        return assign_keys(places, places.columns, "geography_key", start)
    new = places.join(existing, [places[c].eqNullSafe(existing[c]) for c in places.columns], "left_anti")
    return existing.select(*places.columns, "geography_key").unionByName(assign_keys(new, places.columns, "geography_key", start, existing))


def resolve_categories(categories: DataFrame) -> DataFrame:
    """Each category with its parent's name (null at the top)."""
    up = categories.select(F.col("category_id").alias("parent_id"), F.col("name").alias("parent_category"))
    return categories.join(up, "parent_id", "left").select("category_id", "name", "parent_category")


def category_paths(spark: SparkSession, categories: DataFrame) -> DataFrame:
    """Each category with its full path from the top, by recursive SQL over the tree."""
    categories.createOrReplaceTempView("__categories")
    return spark.sql("""with recursive tree(category_id, path) as (select category_id, name from __categories where parent_id is null
      union all select c.category_id, concat(t.path, ' / ', c.name) from __categories c join tree t on c.parent_id = t.category_id)
        select category_id, path from tree""")


def get_watermark(spark: SparkSession, path: str, table: str, now: str, default_hours: int = 2) -> DataFrame:
    """One row (lo, hi]: from the end of the table's last window (or ``default_hours`` back) to ``now``."""
    at = F.lit(now).cast("timestamp")
    back = at - F.make_interval(hours=F.lit(default_hours))
    try:
        state = spark.read.schema("table_name string, window_end timestamp").parquet(path)
        last = state.where(F.col("table_name") == table).agg(F.max("window_end").alias("last"))
    except Exception as e:  # the first run finds no state
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = spark.range(1).select(F.lit(None).cast("timestamp").alias("last"))
    return last.select(F.coalesce("last", back).alias("lo"), at.alias("hi"))


def put_watermark(spark: SparkSession, path: str, table: str, window_end: str) -> None:
    """Appended only after the table's rows are written."""
    spark.range(1).select(F.lit(table).alias("table_name"), F.lit(window_end).cast("timestamp").alias("window_end")).write.mode(
        "append",
    ).parquet(path)
