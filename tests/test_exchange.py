"""Databases, catalog tables, exports, marts by change, and streams of messages, identities and files."""

import gzip
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators import marketing
from tradewind.sources import catalog, jdbc, lake
from tradewind.streaming import events as stream
from tradewind.streaming import files, identity


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().toString()


# --- databases ---


@pytest.fixture
def shop(spark):
    url, data = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", [(i, datetime(2024, 1, 1 + i % 20, i % 24), i * 10) for i in range(1, 501)]
    data += [(None, datetime(2024, 1, 5), 1), (501, None, 2)]
    df = spark.createDataFrame(data, "id bigint, at timestamp, cents bigint")
    jdbc.load_jdbc(df.repartition(12), url, "orders", mode="overwrite", connections=3)
    return url, df


def test_the_window_is_the_databases(spark, shop):
    url, df = shop
    got = jdbc.extract_jdbc(spark, url, "orders", "at", "2024-01-03 00:00:00", "2024-01-07 05:00:00", "id", partitions=8)
    assert rows(got) == rows(df.where("at > timestamp'2024-01-03' and at <= timestamp'2024-01-07 05:00:00'"))
    assert got.rdd.getNumPartitions() == 8
    pushed = plan(got.select("cents"))
    assert "*GreaterThan(at,2024-01-03 00:00:00.0), *LessThanOrEqual(at,2024-01-07 05:00:00.0)" in pushed
    assert "Filter (" not in pushed.split("Physical Plan")[1] and "ReadSchema: struct<cents:bigint>" in pushed
    low, high = jdbc.bounds(spark, url, "orders", "id", "at", "2024-01-03 00:00:00", "2024-01-07 05:00:00")
    assert (low, high) == df.where("at > timestamp'2024-01-03' and at <= timestamp'2024-01-07 05:00:00'").agg(F.min("id"), F.max("id")).first()
    assert jdbc.bounds(spark, url, "orders", "id", "at", "2030-01-01 00:00:00") is None


def test_open_ends_and_empty_windows(spark, shop):
    url, df = shop
    take = lambda lo, hi: jdbc.extract_jdbc(spark, url, "orders", "at", lo, hi, "id")
    assert take(None, None).count() == 502 and take("2030-01-01 00:00:00", None).count() == 0
    early, late = take(None, "2024-01-07 00:00:00"), take("2024-01-07 00:00:00", None)
    assert rows(early.unionByName(late)) == rows(df.where("at is not null"))
    jdbc.load_jdbc(late, url, "copy")
    jdbc.load_jdbc(early, url, "copy")
    assert rows(jdbc.jdbc_table(spark, url, "copy")) == rows(df.where("at is not null"))
    jdbc.load_jdbc(early, url, "copy", mode="overwrite")
    assert jdbc.jdbc_table(spark, url, "copy").count() == early.count()


# --- catalog ---


@pytest.fixture
def table(spark, tmp_path):
    base, name = f"file://{tmp_path}", f"t{uuid.uuid4().hex}"
    data = [(i, datetime(2024, 1 + i % 6, 1 + i % 3)) for i in range(60)]
    lake.write_lake(spark.createDataFrame(data, "id bigint, at timestamp"), base, "x", "at")
    catalog.create_table(spark, name, "id bigint, at timestamp", f"{base}/x")
    return base, name


def test_a_dry_run_changes_nothing_and_a_drop_is_logged(spark, table):
    base, name = table
    before = rows(catalog.partitions(spark, name))
    planned = catalog.drop_expired(spark, name, f"{base}/x", 2, "2024-06-15", f"{base}/log", dry_run=True)
    assert {r[1][:7] for r in planned} == {"2024-01", "2024-02", "2024-03"} and {r[2] for r in planned} == {"would drop"}
    assert rows(catalog.partitions(spark, name)) == before and spark.table(name).count() == 60
    assert not lake._manifest(spark, f"{base}/log", lake.MAINTENANCE_LOG).count()
    done = catalog.drop_expired(spark, name, f"{base}/x", 2, "2024-06-15", f"{base}/log")
    assert [r[1] for r in done] == [r[1] for r in planned]
    catalog.repair(spark, name)
    assert {r.month for r in catalog.partitions(spark, name).collect()} == {"04", "05", "06"}
    assert {r.month for r in spark.read.parquet(f"{base}/x").select(F.lpad(F.col("month").cast("string"), 2, "0").alias("month")).distinct().collect()} == {"04", "05", "06"}
    log = spark.read.parquet(f"{base}/log")
    assert {(r.table_name, r.partition_name, r.action) for r in log.collect()} == {(name, r[1], "dropped") for r in done}
    assert catalog.drop_expired(spark, name, f"{base}/x", 2, "2024-06-15", f"{base}/log") == []


def test_the_catalog_prunes_and_repairs(spark, table):
    base, name = table
    day = spark.table(name).where("year = '2024' and month = '05' and day = '02'")
    # Only the day's folder is handed to the scan.
    assert "PartitionFilters: [isnotnull(year" in plan(day) and len(day.inputFiles()) == 1
    lake.write_lake(spark.createDataFrame([(99, datetime(2025, 1, 1))], "id bigint, at timestamp"), base, "x", "at")
    assert spark.table(name).where("id = 99").count() == 0
    catalog.repair(spark, name)
    assert spark.table(name).where("id = 99").count() == 1


# --- exports ---


def test_a_failed_export_has_its_row(spark, tmp_path):
    base = f"file://{tmp_path}"
    df = spark.createDataFrame([(i, datetime(2024, 1, 1, i)) for i in range(24)], "id bigint, at timestamp")
    jobs = [lake.Export("a", df, "at", 12), lake.Export("bad", df.where("raise_error('no') is null")), lake.Export("gone", lambda: spark.table("no_such_table")), lake.Export("b", df)]
    got = {r.table_name: r for r in lake.export_jobs(spark, jobs, base, f"{base}/log", "2024-01-01").collect()}
    assert {k: (r.row_count, r.status) for k, r in got.items()} == {"a": (12, "SUCCESS"), "bad": (None, "FAILED"), "gone": (None, "FAILED"), "b": (24, "SUCCESS")}
    assert got["a"].window_start == "2024-01-01 12:00:00" and got["a"].window_end == "2024-01-02 00:00:00" and got["b"].window_start is None
    size = sum(f.stat().st_size for f in (tmp_path / "a" / "2024-01-01").glob("part-*"))
    assert got["a"].bytes >= size > 0 and got["a"].path == f"{base}/a/2024-01-01" and got["a"].started_at <= got["a"].ended_at
    assert "no" in got["bad"].error and "no_such_table" in got["gone"].error
    assert spark.read.parquet(f"{base}/log").count() == 4


def test_reports_by_name(spark, tmp_path):
    base = f"file://{tmp_path}"
    reports = {n: (lambda n=n: spark.createDataFrame([(n, 1)], "x string, y int")) for n in ("monthly_revenue", "rfm", "revenue_by_city")}
    got = lake.export_reports(spark, reports, base, f"{base}/log", "2024-01-01", like="Revenue")
    assert {r.table_name for r in got.collect()} == {"monthly_revenue", "revenue_by_city"}
    assert len(list((tmp_path / "monthly_revenue" / "2024-01-01").glob("part-*.csv"))) == 1
    assert lake.export_reports(spark, reports, base, f"{base}/log", "2024-01-01", like="nothing").count() == 0


# --- marts ---


def test_readers_stay_on_the_version_that_is_whole(spark, tmp_path):
    base, df = f"file://{tmp_path}", spark.range(5).withColumnRenamed("id", "x")
    with pytest.raises(ValueError, match="no version"):
        lake.read_mart(spark, base, "m")
    lake.publish_mart(df, base, "m", "v1")
    with pytest.raises(Exception, match="half-way"):
        lake.publish_mart(df.withColumn("x", F.when(F.col("x") == 4, F.raise_error(F.lit("half-way"))).otherwise(F.col("x")).cast("long")), base, "m", "v2")
    assert lake.mart_version(spark, base, "m") == "v1" and lake.read_mart(spark, base, "m").count() == 5
    lake.publish_mart(df.limit(2), base, "m", "v10")
    assert lake.mart_version(spark, base, "m") == "v10" and lake.read_mart(spark, base, "m").count() == 2
    assert lake.read_mart(spark, base, "m", "v1").count() == 5


def test_a_refresh_rewrites_the_changed_day_only(spark, tmp_path):
    base = f"file://{tmp_path}"
    data = [(i, datetime(2024, 1, 1 + i % 4), 1) for i in range(40)]
    frame = lambda d: spark.createDataFrame(d, "id bigint, at timestamp, n bigint")
    mart = lambda df: df.groupBy(F.col("at").cast("date").alias("d")).agg(F.sum("n").alias("n"))
    build = lambda df: lambda days: mart(df.join(days.withColumnRenamed("day", "d_"), F.col("at").cast("date") == F.col("d_"), "left_semi"))
    df = frame(data)
    assert lake.refresh_days(lake.changed_days(df, "at", None, "2024-01-04 00:00:00"), build(df), base, "m", "d", "1") == 4
    mtimes = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if "_days" not in str(p)}
    more = frame([*data, (99, datetime(2024, 1, 3, 5), 7), (100, datetime(2024, 1, 9), 1)])
    late = lake.changed_days(more.where("id >= 99"), "at", "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert lake.refresh_days(late, build(more), base, "m", "d", "2") == 2
    assert {p for p in tmp_path.rglob("*.parquet") if "_days" not in str(p) and p not in mtimes} == set(tmp_path.glob("m/data/day=*/version=2/*.parquet"))
    assert all(p.stat().st_mtime_ns == t for p, t in mtimes.items())
    assert rows(lake.read_days(spark, base, "m")) == rows(mart(more))
    # A refresh that fails leaves every day as it was.
    with pytest.raises(Exception, match="half-way"):
        broken = lambda days: build(more)(days).withColumn("n", F.when(F.col("d") == date(2024, 1, 3), F.raise_error(F.lit("half-way"))).otherwise(F.lit(0)).cast("long"))
        lake.refresh_days(lake.changed_days(more, "at", None, "2024-02-01 00:00:00"), broken, base, "m", "d", "3")
    assert rows(lake.read_days(spark, base, "m")) == rows(mart(more))
    # A day that lost its rows reads as empty; the same version again replaces itself.
    fewer = more.where("at <> timestamp'2024-01-09'")
    gone = spark.createDataFrame([(date(2024, 1, 9),)], "day date")
    for _ in range(2):
        lake.refresh_days(gone, build(fewer), base, "m", "d", "4")
    assert rows(lake.read_days(spark, base, "m")) == rows(mart(fewer))


# --- messages ---


def _send(spark, base, messages):
    spark.createDataFrame(messages, "message_id string, body string").coalesce(1).write.mode("append").json(f"{base}/in")


def _run(spark, base, run="c", **more):
    raw = spark.readStream.schema("message_id string, body string").json(f"{base}/in")
    stream.start_ingest(raw, f"{base}/t", f"{base}/l", f"{base}/log-{run}", f"{base}/{run}", once=True, **more).awaitTermination()
    log = spark.read.parquet(f"{base}/log-{run}")
    return {(r.batch, r.status): r for r in log.collect()}


GOOD = [(str(i), f'{{"event_type": "search", "occurred_at": "2024-01-0{1 + i % 3}T10:00:00Z"}}') for i in range(6)]


def test_a_redelivery_never_reads_the_target(spark, tmp_path):
    base = f"file://{tmp_path}"
    _send(spark, base, [*GOOD, ("x", "broken")])
    log = _run(spark, base)
    first = log[0, "done"]
    assert (first.valid, first.inserted, first.failed, first.repeats, first.state_rows, first.input_rows) == (6, 6, 1, 0, 7, 7)
    assert first.elapsed_ms > 0 and first.error is None
    # The target is gone, as only the state can know: were it read, the events would be written again.
    (tmp_path / "t").rename(tmp_path / "elsewhere")
    _send(spark, base, [*GOOD, ("x", "broken")])
    later = [r for (b, _), r in _run(spark, base).items() if b > 0]
    assert tuple(sum(x) for x in zip(*((r.valid, r.inserted, r.failed, r.repeats) for r in later), strict=True)) == (6, 0, 1, 7)
    assert {r.state_rows for r in later} == {7}
    assert not (tmp_path / "t").exists()


def test_after_the_watermark_the_target_knows(spark, tmp_path):
    base = f"file://{tmp_path}"
    _send(spark, base, GOOD)
    _run(spark, base, within="0 seconds")
    _send(spark, base, [("7", GOOD[0][1])])
    _run(spark, base, within="0 seconds")
    _send(spark, base, GOOD)
    log = _run(spark, base, within="0 seconds")
    last = log[max(b for b, _ in log), "done"]
    assert last.state_rows < 7 and sum(r.inserted for r in log.values()) == 7
    assert spark.read.parquet(f"{base}/t").count() == 7


def test_times_out_of_range_are_broken_events(spark, tmp_path):
    base = f"file://{tmp_path}"
    odd = [("a", '{"event_type": "search", "occurred_at": 1704103200}'), ("b", '{"event_type": "search", "occurred_at": "2924-01-01"}'), ("c", '{"event_type": "search"}')]
    _send(spark, base, [*GOOD, *odd])
    log = _run(spark, base)[0, "done"]
    assert (log.valid, log.failed, log.inserted) == (7, 2, 7)
    assert {(r.message_id, r.error) for r in spark.read.parquet(f"{base}/l").collect()} == {("a", "occurred_at is out of range"), ("b", "occurred_at is out of range")}


def test_days_of_a_batch_are_those_that_occur(spark):
    e = spark.createDataFrame([(datetime(2020, 1, 1), True, None), (datetime(2024, 5, 5), True, None), (datetime(2021, 1, 1), True, "bad")], "occurred_at timestamp, timed boolean, error string")
    assert sorted(stream.batch_days(e)) == [date(2020, 1, 1), date(2024, 5, 5)]
    e = spark.createDataFrame([(datetime(2024, 5, 20), False, None)], "occurred_at timestamp, timed boolean, error string")
    assert len(stream.batch_days(e)) == stream.REDELIVERY_DAYS + 1


def test_a_batch_that_fails_is_logged_and_run_again(spark, tmp_path, monkeypatch):
    base, real = f"file://{tmp_path}", stream.ingest_batch
    _send(spark, base, GOOD)

    def fails(*a):
        real(*a)
        raise RuntimeError("no more disk")

    monkeypatch.setattr(stream, "ingest_batch", fails)
    with pytest.raises(Exception, match="no more disk"):
        _run(spark, base)
    log = {(r.batch, r.status): r for r in spark.read.parquet(f"{base}/log-c").collect()}
    assert set(log) == {(0, "failed")} and "no more disk" in log[0, "failed"].error
    monkeypatch.setattr(stream, "ingest_batch", real)
    log = _run(spark, base)
    assert log[0, "done"].inserted == 0 and (0, "failed") in log
    assert spark.read.parquet(f"{base}/t").count() == 6


def test_a_batch_leaves_few_files(spark, tmp_path):
    base = f"file://{tmp_path}"
    _send(spark, base, [(str(i), GOOD[i % 3][1]) for i in range(300)])
    _run(spark, base)
    assert len(list((tmp_path / "t").glob("*/*.parquet"))) <= 6


# --- identities ---


def test_an_event_may_come_before_its_session(spark, tmp_path):
    base = f"file://{tmp_path}"
    sessions = spark.createDataFrame([("a", 1, datetime(2024, 1, 1)), ("b", None, datetime(2024, 1, 1)), ("b", 2, datetime(2024, 1, 3)), ("a", 9, datetime(2024, 1, 4)), (None, 5, datetime(2024, 1, 1))], "anonymous_id string, customer_key bigint, started_at timestamp")
    events = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "b", 7), (4, None, None), (5, "c", None), (6, "a", None)], "event_id bigint, anonymous_id string, customer_key bigint")
    schema = "event_id bigint, anonymous_id string, customer_key bigint"

    def batch(part):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        identity.start_stitching(spark.readStream.schema(schema).parquet(f"{base}/in"), base, f"{base}/out", f"{base}/c", once=True).awaitTermination()
        return {r.event_id: r.customer_key for r in identity.read_stitched(spark, f"{base}/out").collect()}

    assert batch(events.where("event_id <= 3")) == {1: None, 2: None, 3: 7}
    identity.publish_identities(sessions.where("started_at < timestamp'2024-01-02'"), base, "1")
    assert batch(events.where("event_id in (4, 5)")) == {1: None, 2: None, 3: 7, 4: None, 5: None}
    assert identity.late_pass(spark, base, f"{base}/out") == 1
    identity.publish_identities(sessions, base, "2")
    # The same stream reads the new version: event 6 has the newest customer at once, event 1 after the late pass.
    assert batch(events.where("event_id = 6"))[6] == 9
    assert identity.late_pass(spark, base, f"{base}/out") == 2
    assert identity.late_pass(spark, base, f"{base}/out") == 2
    want = marketing.stitch_identity(events, sessions)
    assert rows(identity.read_stitched(spark, f"{base}/out").select("event_id", "customer_key")) == rows(want.select("event_id", "customer_key"))


# --- files ---


def test_files_go_to_their_zones_once(spark, tmp_path):
    drop, base = tmp_path / "drop", f"file://{tmp_path}/zones"
    drop.mkdir()
    (drop / "good.csv").write_text('event_id,event_type,occurred_at,event_id\n1,"a,b",2024,x\n2,c,2025,y\n\n')
    (drop / "bad.csv").write_text("event_id,kind\n1,2,3\n,2\n")
    (drop / "packed.csv.gz").write_bytes(gzip.compress(b"occurred_at,event_id,event_type\n2024,3,z\n"))

    def run(kind="csv"):
        files.start_routing(spark, f"file://{drop}", base, "events", kind, f"{base}/c-{kind}", archive=None, once=True).awaitTermination()
        return [spark.read.parquet(f"{base}/{z}/events") for z in ("processed", "quarantine", "reports", "alerts")]

    for _ in range(2):
        processed, quarantined, reports, alerts = run()
        assert rows(processed.select("event_id", "event_type", "occurred_at")) == [("1", "a,b", "2024"), ("2", "c", "2025"), ("3", "z", "2024")]
        assert rows(quarantined.select("pos", "value")) == [(0, "event_id,kind"), (1, "1,2,3"), (2, ",2")]
        assert {r.file.rsplit("/", 1)[1]: r.status for r in reports.collect()} == {"good.csv": "VALID", "bad.csv": "INVALID", "packed.csv.gz": "VALID"}
        assert [(r.file.rsplit("/", 1)[1], r.message) for r in alerts.collect()] == [("bad.csv", "file is INVALID")]
    # A file that comes later is a batch of its own.
    (drop / "later.csv").write_text("event_id,event_type,occurred_at\n4,q,2024\n")
    processed, _, reports, _ = run()
    assert processed.count() == 4 and reports.count() == 4


def test_finished_files_are_archived(spark, tmp_path):
    drop, base = tmp_path / "drop", f"file://{tmp_path}/zones"
    drop.mkdir()
    for i in range(3):
        (drop / f"f{i}.jsonl").write_text(f'{{"event_id": {i}, "event_type": "x", "occurred_at": "2024"}}\n')
        files.start_routing(spark, f"file://{drop}", base, "events", "jsonl", f"{base}/c", archive=f"file://{tmp_path}/archive", once=True).awaitTermination()
    assert spark.read.parquet(f"{base}/processed/events").count() == 3
    assert any((tmp_path / "archive").rglob("f0.jsonl")) and not (drop / "f0.jsonl").exists()
