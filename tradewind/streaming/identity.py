"""Identity stitching on a stream: events without a customer take the one last known for their anonymous id.

The mapping is a mart with versions. Each batch joins the version that is valid at its time (a stream-static join that
is read anew), so an event may come before its identity is known, or before it changes. A late pass compares two
versions of the mapping and corrects the events of identities that differ; readers see the newest correction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.functions.store import discard, save
from tradewind.sources.lake import mart_version, publish_mart, read_mart

MART = "identities"


def known_customers(sessions: DataFrame) -> DataFrame:
    """anonymous_id, known_customer: the customer of the latest session that has one."""
    latest = F.max_by("customer_key", F.struct("started_at", "customer_key"))
    return sessions.where("customer_key is not null and anonymous_id is not null").groupBy("anonymous_id").agg(latest.alias("known_customer"))


def publish_identities(sessions: DataFrame, base: str, version: str) -> str:
    return publish_mart(known_customers(sessions), base, MART, version)


def stitch_batch(spark: SparkSession, events: DataFrame, batch_id: int, base: str, target: str) -> None:
    """Writes the batch with the known customers of the valid mapping; a batch that is run again replaces itself.

    Rows keep their own customer and the one looked up apart, so that a late pass can tell them."""
    version, stored = mart_version(spark, base, MART), save(events, "to-stitch", spark)
    events = stored
    if version is None:
        out = events.withColumn("known_customer", F.lit(None).cast(dict(events.dtypes)["customer_key"]))
    else:
        out = events.join(read_mart(spark, base, MART, version), "anonymous_id", "left")
    out.write.mode("overwrite").parquet(f"{target}/events/batch={batch_id}")
    discard(stored)


def start_stitching(events: DataFrame, base: str, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Streams events (event_id, anonymous_id, customer_key and more) into ``target``."""
    spark = events.sparkSession
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: stitch_batch(spark, b, i, base, target))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def late_pass(spark: SparkSession, base: str, target: str, version: str | None = None) -> int:
    """Corrects stitched events whose identity differs in ``version`` (the valid one) from what readers see; returns
    how many. Only events without a customer of their own are looked at, and one that is corrected again gets a newer
    correction, never a change in place. Corrections lie under the version, so a pass that is run again replaces itself."""
    version = version or mart_version(spark, base, MART)
    now = _seen(spark, target, without=version).where("customer_key is null and anonymous_id is not null")
    now = now.select("event_id", "anonymous_id", F.col("known_customer").alias("seen"))
    found = now.join(read_mart(spark, base, MART, version), "anonymous_id", "left")
    wrong = found.where(~F.col("known_customer").eqNullSafe(F.col("seen"))).select("event_id", "known_customer")
    stored = save(wrong.withColumn("at", F.lit(_order(spark, base, version)).cast("long")), "corrections")
    stored.write.mode("overwrite").parquet(f"{target}/corrections/version={version}")
    return stored.count()


def _order(spark: SparkSession, base: str, version: str) -> int:
    """The place of a version among all that were published."""
    log = spark.read.parquet(f"{base}/{MART}/_manifest")
    return log.where(F.col("version") == version).agg(F.max("seq")).first()[0]


def _seen(spark: SparkSession, target: str, without: str | None = None) -> DataFrame:
    """Events with the newest known customer; ``without``: as before that version's corrections."""
    events = spark.read.parquet(f"{target}/events").drop("batch")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/corrections")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return events
    fixes = spark.read.parquet(f"{target}/corrections")
    if without is not None:
        fixes = fixes.where(F.col("version").cast("string") != without)
    fixes = fixes.groupBy("event_id").agg(F.max_by(F.struct("known_customer"), "at").alias("fix"))
    known = F.when(F.col("fix").isNotNull(), F.col("fix.known_customer")).otherwise(F.col("known_customer"))
    return events.join(fixes, "event_id", "left").withColumn("known_customer", known).drop("fix")


def read_stitched(spark: SparkSession, target: str) -> DataFrame:
    """The events with ``customer_key`` filled in where it was absent and is known."""
    return _seen(spark, target).withColumn("customer_key", F.coalesce("customer_key", "known_customer")).drop("known_customer")
