"""Event ingest: messages with an object or an array, validation, dead letters, idempotent writes, metrics, funnel.

The column functions work on static and streaming frames alike. Repeats are dropped by the stream's state first and by
the target second; the sink runs in ``foreachBatch``, the log in a listener.
"""

from __future__ import annotations

import uuid
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tradewind.functions.store import discard, save

FIELDS = (
    "event_id",
    "session_id",
    "customer_id",
    "anonymous_id",
    "event_type",
    "occurred_at",
    "page_url",
    "page_title",
    "referrer_url",
    "product_id",
    "order_id",
    "search_query",
    "properties",
)
EVENT = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">"
#: Event types and the longest texts kept.
TYPES = (
    "page_view",
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "checkout_start",
    "checkout_step",
    "purchase",
    "search",
    "wishlist_add",
    "coupon_applied",
    "session_start",
    "session_end",
)
LONGEST = {"page_url": 2048, "page_title": 500, "search_query": 500}
UUID = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
TARGET = "event_id string, event_type string, occurred_at timestamp, session_id string, customer_id string, anonymous_id string, page_url string, page_title string, referrer_url string, product_id string, order_id string, search_query string, properties string, event_date date"
METRICS = "valid long, inserted long, failed long, elapsed_ms long, input_rows long, repeats long, state_rows long, error string"
ARRIVED = "arrived"
#: How long a queue may deliver a message again; how much of that the state remembers; how old an event may be.
REDELIVERY_DAYS, REMEMBERED, OLDEST_DAYS = 14, "1 day", 3650
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def parse_events(raw: DataFrame) -> DataFrame:
    """One row per event of each message (``message_id``, ``body`` and, if the queue tells it, ``sent_at``); a message
    that is no object or array (of objects) gives one row with an error. The n-th event of a message has ``pos`` n,
    from 0."""
    if "sent_at" not in raw.columns:
        raw = raw.withColumn("sent_at", F.lit(None).cast("timestamp"))
    body = F.trim("body")
    sound = F.try_parse_json(body).isNotNull()
    many = F.when(sound & body.startswith("["), F.from_json(body, f"array<{EVENT}>")).when(
        sound & body.startswith("{"),
        F.array(F.from_json(body, EVENT)),
    )
    df = raw.withColumn("events", many).select("*", F.posexplode_outer("events").alias("pos", "e"))
    broken = F.when(F.col("events").isNull(), "body is not a JSON object or array").when(
        F.col("e").isNull() & F.col("pos").isNotNull(),
        "array element is not an object",
    )
    df = df.where("pos is not null or events is null")
    return df.select("message_id", "body", "sent_at", F.coalesce("pos", F.lit(0)).alias("pos"), "e.*", broken.alias("error"))


def validate_events(events: DataFrame, now: str | None = None) -> DataFrame:
    """Cleaned events with ``error``: a type is required and must be known; times are ISO or epoch milliseconds, absent
    ones become the time the message was sent, or ``now`` (``timed``: whether the event has a time of its own); ids that
    are no UUID become null, an absent event_id is made from message and position, so a retry gives the same; long texts
    are cut."""
    at = F.coalesce("sent_at", F.lit(now).cast("timestamp") if now else F.current_timestamp())
    kind = F.nullif(F.lower(F.trim("event_type")), F.lit(""))
    raw = F.nullif(F.trim("occurred_at"), F.lit(""))
    when = (
        F.when(raw.isNull(), at)
        .when(raw.rlike("^[0-9]+$"), F.timestamp_millis(raw.try_cast("bigint")))
        .otherwise(F.try_to_timestamp(raw))
    )
    uuid = lambda c: F.when(F.col(c).rlike(UUID), F.lower(c))
    h = F.sha2(F.concat_ws("-", "message_id", "pos"), 256)
    made = F.concat_ws("-", *[F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    error = F.coalesce(
        F.col("error"),
        F.when(kind.isNull(), "event_type is required"),
        F.when(~kind.isin(*TYPES), F.concat(F.lit("unknown event_type: "), kind)),
        F.when(when.isNull(), "occurred_at is not a time"),
    )
    texts = ("page_url", "page_title", "referrer_url", "product_id", "order_id", "search_query", "properties")
    cut = {c: F.substring(c, 1, n) for c, n in LONGEST.items()}
    return events.select(
        "message_id", "pos", "body", F.coalesce(uuid("event_id"), made).alias("event_id"), kind.alias("event_type"), when.alias("occurred_at"),
        *[uuid(c).alias(c) for c in ("session_id", "customer_id")], "anonymous_id", *[cut.get(c, F.col(c)).alias(c) for c in texts],
        raw.isNotNull().alias("timed"), error.alias("error"),
    )


def dead_letters(events: DataFrame) -> DataFrame:
    """Messages with an invalid event, once each: id, body, first error."""
    return events.where("error is not null").groupBy("message_id", "body").agg(F.min_by("error", "pos").alias("error"))


def fresh_events(events: DataFrame, target: DataFrame | None) -> DataFrame:
    """Valid events that the target lacks, one per (event_id, occurred_at); an event without a time of its own is known
    by its id alone, as a later delivery would give it another time."""
    ok = events.where("error is null").drop("error", "message_id", "pos", "body")
    own = ok.where("timed").drop("timed").dropDuplicates(["event_id", "occurred_at"])
    bare = ok.where("not timed").drop("timed").dropDuplicates(["event_id"])
    # A time given and a time taken may be the same in one batch.
    bare = bare.join(own.select("event_id"), "event_id", "left_anti")
    if target is not None:
        own = own.join(target.select("event_id", "occurred_at"), ["event_id", "occurred_at"], "left_anti")
        bare = bare.join(target.select("event_id"), "event_id", "left_anti")
    return own.unionByName(bare)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def once_within(events: DataFrame, within: str = REMEMBERED) -> DataFrame:
    """Validated events of a stream without those that came before: an event by id and time (one without a time of its
    own by id alone), a broken one by message and place. What came is remembered for ``within`` of its arrival, in the
    state store, so state is bounded by the arrivals of that time. Arrival is the clock of the batch, never a time that
    the event states, so an old event is not taken for a late one and lost."""
    at = F.when(F.col("timed"), F.col("occurred_at").cast("string"))
    known = F.when(F.col("error").isNull(), F.concat_ws("|", F.lit("event"), "event_id", at)).otherwise(F.concat_ws("|", F.lit("broken"), "pos", "message_id"))
    arrived = events.withColumns({"arrived_at": F.current_timestamp(), "known_by": known}).withWatermark("arrived_at", within)
    return arrived.dropDuplicatesWithinWatermark(["known_by"]).drop("known_by", "arrived_at")


def in_range(events: DataFrame, oldest_days: int, ahead_days: int = 1, now: str | None = None) -> DataFrame:
    """Events whose time is further back or ahead than stated get an error: epoch seconds read as milliseconds, wrong years."""
    day, today = F.col("occurred_at").cast("date"), F.lit(now).cast("date") if now else F.current_date()
    wrong = F.col("timed") & ((day < F.date_sub(today, oldest_days)) | (day > F.date_add(today, ahead_days)))
    return events.withColumn("error", F.coalesce("error", F.when(wrong, "occurred_at is out of range")))


def batch_days(events: DataFrame) -> list:
    """The days whose events may be the same as valid ones of the batch: their own, and for events without a time those
    of possible earlier deliveries. One value a day that occurs, so at most ``OLDEST_DAYS`` and a few."""
    day = F.col("occurred_at").cast("date")
    days = F.when(F.col("timed"), F.array(day)).otherwise(F.sequence(F.date_sub(day, REDELIVERY_DAYS), day))
    return [r.day for r in events.where("error is null").select(F.explode(days).alias("day")).distinct().collect()]


def ingest_batch(events: DataFrame, batch_id: int, target: str, letters: str) -> int:
    """Writes one stored micro-batch of validated events and returns how many were new. A batch that is run again finds
    its events in the target, and overwrites its own letters, which lie in a folder named by the batch. The target lies
    by day; only days that occur in the batch are read, and without valid events none."""
    days, inserted = batch_days(events), 0
    if days:
        have = _stored(events.sparkSession, target, TARGET).where(F.col("event_date").isin(days))
        new = save(fresh_events(events, have).withColumn("event_date", F.col("occurred_at").cast("date")), "fresh")
        inserted = new.count()
        if inserted:
            # Few files a day: rows are dealt by day, and a day with many rows is split.
            new.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(target)
        discard(new)
    dead_letters(events).withColumn("failed_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{letters}/batch={batch_id}")
    return inserted


class BatchLog(StreamingQueryListener):
    """A row per batch of one query under ``path``/batch=/status=, from what the engine reports: events valid and failed
    as they arrived, repeats that the state dropped, keys in the state, rows inserted, times; a failed batch has its
    error. Written from outside the batch function, so a batch that fails is logged as well."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.inserted: dict[int, int] = {}
        self.id, self.next, self.ended = None, 0, Event()

    def _write(self, batch: int, status: str, row: tuple) -> None:
        log = self.spark.createDataFrame([row], METRICS).withColumn("at", F.current_timestamp())
        log.write.mode("overwrite").parquet(f"{self.path}/batch={batch}/status={status}")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        if event.name == self.name:
            self.id = event.id

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.name != self.name or ARRIVED not in p.observedMetrics:
            return
        seen = p.observedMetrics[ARRIVED]
        state = sum(x.numRowsTotal for x in p.stateOperators)
        repeats = sum(x.customMetrics.get("numDroppedDuplicateRows", 0) for x in p.stateOperators)
        self.next = p.batchId + 1
        done = (seen.valid, self.inserted.pop(p.batchId, 0), seen.failed, p.durationMs.get("triggerExecution", 0), p.numInputRows, repeats, state, None)
        self._write(p.batchId, "done", done)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.id == self.id:
            try:
                if event.exception:
                    self._write(self.next, "failed", (None, None, None, None, None, None, None, event.exception[:4000]))
            finally:
                self.ended.set()


class Ingest:
    """A running ingest: the streaming query, and its log."""

    def __init__(self, query: StreamingQuery, log: BatchLog):
        self.query, self.log = query, log

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802
        """As of the query; when it has ended, its log is complete."""
        try:
            ended = self.query.awaitTermination(timeout) if timeout is not None else self.query.awaitTermination()
        finally:
            if not self.query.isActive:
                self._close()
        return ended

    def stop(self) -> None:
        self.query.stop()
        self._close()

    def _close(self) -> None:
        self.log.ended.wait(60)
        self.log.spark.streams.removeListener(self.log)


def start_ingest(
    raw: DataFrame,
    target: str,
    letters: str,
    metrics: str,
    checkpoint: str,
    once: bool = False,
    within: str = REMEMBERED,
    oldest_days: int = OLDEST_DAYS,
) -> Ingest:
    """Streams messages into the target: every 5 seconds, or (``once``) all that is there.

    A message that comes again within ``within`` is dropped by the state, before the target is looked at; one after that
    is found in the target. Both hold after a restart from ``checkpoint``. State lies in RocksDB."""
    spark, name = raw.sparkSession, f"ingest-{uuid.uuid4().hex}"
    log = BatchLog(spark, name, metrics)
    events = in_range(validate_events(parse_events(raw)), oldest_days)
    valid = F.col("error").isNull()
    events = events.observe(ARRIVED, F.count(F.when(valid, 1)).alias("valid"), F.count(F.when(~valid, 1)).alias("failed"))

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = save(batch, "arrived", spark)
        log.inserted[batch_id] = ingest_batch(stored, batch_id, target, letters)
        discard(stored)

    writer = once_within(events, within).writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")
    spark.streams.addListener(log)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        # The query keeps the settings of its start.
        return Ingest(writer.start(), log)
    except Exception:
        spark.streams.removeListener(log)
        raise
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def stream_funnel(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Daily sessions per step on a stream: tumbling windows with a watermark. A session counts once per step and day;
    what was counted is remembered until the watermark passes, so state is bounded by ``delay``."""
    steps = ("page_view", "product_view", "add_to_cart", "checkout_start", "purchase")
    at = events.withWatermark("occurred_at", delay).where(F.col("event_type").isin(*steps))
    # The day's first moment stands for the event, so that repeats are equal and the watermark can drop them.
    day = at.select(F.window("occurred_at", "1 day").alias("day"), "event_type", "session_id").distinct()
    counts = [F.count(F.when(F.col("event_type") == s, F.col("session_id"))).alias(s) for s in steps]
    return day.groupBy("day").agg(*counts).select(F.col("day.start").cast("date").alias("event_date"), *steps)
