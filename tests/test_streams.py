"""Streams: the whole path from drop files to tables, restarts, and late data."""

import glob
import json
import os
import time
from datetime import datetime

import pytest
from compare import compare, connect
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.constants import TOPIC_ERRORS, TOPIC_READINGS, TOPIC_RETRY
from sensorloom.operators.alerts import alert_rows
from sensorloom.operators.archive import archive_rows
from sensorloom.operators.cooldown import cooldown
from sensorloom.operators.routing import is_diverted, region_map, to_error_records
from sensorloom.operators.rules import ALERT_PROFILE, detect_candidates
from sensorloom.operators.validate import rejected_readings, valid_readings
from sensorloom.plans import catalog
from sensorloom.plans.oracles import ORACLES
from sensorloom.schemas import ERRORS_TABLE, RAW_COLUMNS
from sensorloom.sources.drops import stream_drops
from sensorloom.sources.events import raw_readings
from sensorloom.sources.publish import publish
from sensorloom.sources.topics import StoredTopics
from sensorloom.streaming import consumers as c
from sensorloom.streaming.ingest import RegionTable, start_ingest
from sensorloom.streaming.observed import MetricLog, ProgressLog, kafka_offsets

NOW = {"availableNow": True}
RATE = 0.2


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def write_drop(folder, name, rows, moment):
    """A drop file that appears at once and whose time leaves no doubt about the order."""
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{name}")
    with open(hidden, "w", encoding="utf-8") as f:
        f.write("Location,Date_Time,Temperature_C,Humidity_pct,Precipitation_mm,Wind_Speed_kmh\n")
        for r in rows:
            f.write(",".join(r[c] for c in RAW_COLUMNS) + "\n")
    os.utime(hidden, (moment, moment))
    os.rename(hidden, os.path.join(folder, name))


@pytest.fixture(scope="module")
def parts(spark):
    """The readings of the smallest table in four parts by time."""
    rows = raw_readings(spark, "/root/testdata/sf0.001").orderBy("event_id").collect()
    size = -(-len(rows) // 4)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def test_drop_files_to_tables(spark, parts, tmp_path):
    drops, root = str(tmp_path / "drops"), str(tmp_path)
    topics = StoredTopics(f"{root}/topics")
    regions = RegionTable(f"{root}/regions")
    regions.start_with(region_map(spark))
    base = time.time() - 1000

    def run_ingest():
        return finish(
            start_ingest(
                stream_drops(spark, drops, files_per_trigger=1), topics, regions,
                f"{root}/cp/ingest", f"{root}/counts", trigger=NOW,
            )
        )

    def run_consumers():
        def records(topic, **kwargs):
            return topics.stream(spark, topic, **kwargs)

        finish(c.start_alerts(records(TOPIC_READINGS), f"{root}/alerts", c.AlertState(f"{root}/state"),
                              f"{root}/cp/alerts", rate=RATE, topics=topics,
                              quarantine=f"{root}/bad_alerts", trigger=NOW))
        finish(c.start_archive(c.decode_readings(records(TOPIC_READINGS)), f"{root}/archive",
                               f"{root}/cp/archive", trigger=NOW))
        finish(c.start_retries(records(TOPIC_RETRY), f"{root}/retry_alerts",
                               c.AlertState(f"{root}/retry_state"), f"{root}/cp/retry", topics=topics,
                               fail_rate=0.01, trigger=NOW))
        finish(c.start_errors(records(TOPIC_ERRORS), f"{root}/errors", f"{root}/bad_errors",
                              f"{root}/cp/errors", trigger=NOW))

    # two parts, stop, the other two, and a last run with nothing new
    for i, part in enumerate(parts[:2]):
        write_drop(drops, f"weather_{i}.csv", part, base + 10 * i)
    run_ingest()
    run_consumers()
    for i, part in enumerate(parts[2:], 2):
        write_drop(drops, f"weather_{i}.csv", part, base + 10 * i)
    run_ingest()
    run_consumers()
    run_ingest()
    run_consumers()

    rows = [r for part in parts for r in part]
    raw = spark.createDataFrame(rows)
    valid = valid_readings(raw).withColumn("event_time", F.try_to_timestamp("date_time")).cache()

    counts = spark.read.parquet(f"{root}/counts").agg(F.sum("success_count"), F.sum("error_count")).first()
    assert tuple(counts) == (valid.count(), len(rows) - valid.count())

    stored = topics.read(spark, TOPIC_READINGS)
    assert stored.count() == valid.count()
    placed = {(r.key, r.partition) for r in stored.select("key", "partition").distinct().collect()}
    known = {(r.location, r.partition) for r in region_map(spark).collect()}
    assert known <= placed | known and {p for p in placed if p[0] in ("Busan", "Jeju")} == {
        p for p in placed if p not in known
    }
    assert sorted(p[1] for p in placed - known) == [0, 1]

    timed = valid.where("event_time is not null")
    diverted = timed.where(is_diverted(*c.IDENTITY, rate=RATE))
    retries = topics.read(spark, TOPIC_RETRY)
    assert retries.count() == diverted.count() > 0
    assert all(set(json.loads(r.value)) >= {"event_time", "Temperature_C"} for r in retries.collect())

    # stream = batch
    checked = timed.where(~is_diverted(*c.IDENTITY, rate=RATE)).withColumn("reading_id", F.xxhash64(*c.IDENTITY))
    found = detect_candidates(checked, ALERT_PROFILE, "reading_id", "location", "event_time")
    expected = alert_rows(cooldown(found, tie="reading_id"), ALERT_PROFILE)
    alerts = spark.read.parquet(f"{root}/alerts")
    columns = ["alert_id", "location", "alert_type", "alert_reason", "event_time", "value", "threshold"]
    assert sorted(alerts.select(columns).collect()) == sorted(expected.select(columns).collect())
    assert alerts.count() > 100

    archive = spark.read.parquet(f"{root}/archive")
    assert archive.count() == archive_rows(valid.drop("event_time")).count()

    errors = spark.read.parquet(f"{root}/errors")
    failed = topics.read(spark, TOPIC_ERRORS).where("producer = 'retry'").count()
    assert errors.count() == len(rows) - valid.count() + failed
    assert set(errors.columns) == {*ERRORS_TABLE.fieldNames(), "batch"}
    assert spark.read.parquet(f"{root}/bad_errors").isEmpty()
    assert errors.select("id").distinct().count() == errors.count()
    assert spark.read.parquet(f"{root}/retry_alerts").count() > 0


def test_replayed_batch_leaves_no_duplicates(spark, parts, tmp_path):
    """A batch that runs again after its outputs were written replaces them."""
    root = str(tmp_path)
    topics, regions = StoredTopics(f"{root}/topics"), RegionTable(f"{root}/regions")
    write_drop(f"{root}/drops", "weather_0.csv", parts[0], time.time() - 100)
    for checkpoint in ("a", "b"):  # a lost checkpoint: batch 0 is run twice
        finish(start_ingest(stream_drops(spark, f"{root}/drops"), topics, regions, f"{root}/{checkpoint}", trigger=NOW))
    valid = valid_readings(spark.createDataFrame(parts[0]))
    assert topics.read(spark, TOPIC_READINGS).count() == valid.count()
    numbers = [r.partition for r in regions.before(spark, 1).collect()]
    assert sorted(numbers) == sorted(n % 10 for n in range(len(numbers)))


@pytest.mark.parametrize("file_number, dropped", [(1, 0), (2, 1)])
def test_late_rows(spark, parts, tmp_path, file_number, dropped):
    """A row far behind is dropped against the watermark of the batch before last."""
    schema = "location string, event_time timestamp"
    timed = [
        [(r.location, datetime.strptime(r.date_time, "%Y-%m-%d %H:%M:%S")) for r in part if "99:99" not in r.date_time]
        for part in parts
    ]
    late = timed[0][0]
    timed[file_number].append(late)
    source = tmp_path / "source"
    for i, rows in enumerate(timed):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        for f in source.glob("*.parquet"):
            if f.stat().st_mtime > time.time() - 500:
                os.utime(f, (time.time() - 1000 + 10 * i,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    out = str(tmp_path / "out")
    query = finish(
        c.start_window_counts(c.window_counts_stream(stream), out, str(tmp_path / "cp"), trigger=NOW)
    )
    lost = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert lost == dropped
    total = c.read_window_counts(spark, out).agg(F.sum("n_rows")).first()[0]
    assert total == sum(map(len, timed)) - dropped


def test_dead_letters_of_a_kafka_topic(spark, parts):
    """The error table on records with the columns of Spark's Kafka source."""
    errors = to_error_records(rejected_readings(spark.createDataFrame(parts[0])))
    received = errors.select(
        F.encode("key", "UTF-8").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        "topic",
        F.lit(3).alias("partition"),
        F.row_number().over(Window.orderBy("value")).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows = c.error_table_stream(received).collect()
    assert len({r.id for r in rows}) == len(rows) == errors.count() > 0
    assert {"error_type", "raw_row", "created_at", "slack_sent"} <= set(rows[0].asDict())


# --- publishing -------------------------------------------------------------------------------
def messages(spark, *rows):
    """Topic records of (location, date_time, temperature) rows."""
    made = [
        (loc, json.dumps({"Location": loc, "Date_Time": at, "Temperature_C": t, "Humidity_pct": 1.0,
                          "Precipitation_mm": 0.0, "Wind_Speed_kmh": 0.0, "retry": 0}), None)
        for loc, at, t in rows
    ]
    return spark.createDataFrame(made, "key string, value string, partition int")


def test_published_once(spark, tmp_path):
    """A place that is taken keeps what it has, and the staged folder stays where it is."""
    root = str(tmp_path)
    for n in (1, 2):
        spark.range(n).write.parquet(f"{root}/staged{n}")
    assert publish(spark, f"{root}/staged1", f"{root}/deep/place")
    assert not publish(spark, f"{root}/staged2", f"{root}/deep/place")
    assert spark.read.parquet(f"{root}/deep/place").count() == 1
    assert sorted(os.listdir(f"{root}/deep")) == ["place"]


def test_lost_producers_are_not_seen(spark, tmp_path):
    """Staged batches reach no reader; a second attempt replaces what the first one staged."""
    topics = StoredTopics(str(tmp_path))
    row = ("Dallas", "2024-01-01 00:00:00", 40.0)
    assert topics.write(messages(spark, row), "t", 0, "p")
    topics.stage(messages(spark, row, row, row), "t", 1, "p")
    assert topics.read(spark, "t").count() == 1
    assert topics.write(messages(spark, row, row), "t", 1, "p")
    assert not topics.write(messages(spark, row), "t", 1, "p")
    assert topics.read(spark, "t").count() == 3


# --- observed metrics -------------------------------------------------------------------------
def run_alerts(spark, topics, root, **kwargs):
    state = c.AlertState(f"{root}/state")
    finish(c.start_alerts(topics.stream(spark, TOPIC_READINGS), f"{root}/alerts", state,
                          f"{root}/cp", rate=0.0, trigger=NOW, **kwargs))
    return {r.batch: r.asDict() for r in state.progress(spark).collect()}


def test_batches_without_alerts_and_without_times(spark, tmp_path):
    root = str(tmp_path)
    topics = StoredTopics(f"{root}/topics")
    topics.write(messages(spark, ("A", "no time", 40.0), ("A", None, 1.0)), TOPIC_READINGS, 0, "p")
    run_alerts(spark, topics, root)
    topics.write(messages(spark, ("A", "2024-01-01 00:00:00", 10.0)), TOPIC_READINGS, 1, "p")
    found = run_alerts(spark, topics, root, quarantine=f"{root}/bad")
    counts = [(b["n_rows"], b["n_without_time"], b["n_late"], b["n_alerts"]) for _, b in sorted(found.items())]
    assert counts == [(2, 2, 0, 0), (1, 0, 0, 0)]
    aside = spark.read.parquet(f"{root}/state/untimed")
    assert sorted((r.date_time or "", r.batch) for r in aside.collect()) == [("", 0), ("no time", 0)]


def test_a_reading_from_the_future_makes_no_other_late(spark, tmp_path):
    root = str(tmp_path)
    topics = StoredTopics(f"{root}/topics")
    rows = [("A", "2999-01-01 00:00:00", 40.0), ("A", "2024-01-01 00:00:00", 10.0)]
    topics.write(messages(spark, *rows), TOPIC_READINGS, 0, "p")
    run_alerts(spark, topics, root)
    topics.write(messages(spark, ("B", "2024-01-01 00:00:01", 40.0), ("B", "2023-01-01 00:00:00", 40.0)),
                 TOPIC_READINGS, 1, "p")
    found = run_alerts(spark, topics, root)
    assert [(b["n_late"], b["n_alerts"]) for _, b in sorted(found.items())] == [(0, 1), (1, 1)]


def test_delivered_again_while_suppressed(spark, tmp_path):
    """A reading that the cooldown suppressed raises nothing when it comes again later."""
    root = str(tmp_path)
    topics = StoredTopics(f"{root}/topics")
    rows = [("A", "2024-01-01 00:00:00", 40.0), ("A", "2024-01-01 00:29:00", 41.0)]
    for n in range(2):
        topics.write(messages(spark, *rows, *rows), TOPIC_READINGS, n, "p")
        run_alerts(spark, topics, root, watermark="2 hours")
    alerts = spark.read.parquet(f"{root}/alerts").collect()
    assert [(a.value, json.loads(a.raw_json)["Temperature_C"]) for a in alerts] == [(40.0, 40.0)]


def test_progress_log(spark, tmp_path):
    """Each micro-batch is one row with what was observed on it; other queries are not logged."""
    root = str(tmp_path)
    for n in range(3):
        spark.range(n + 1).coalesce(1).write.mode("append").parquet(f"{root}/in")
    log = ProgressLog(spark, f"{root}/progress", names=("logged",))
    for name in ("logged", "other"):
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        observed = stream.observe("seen", F.count(F.lit(1)).alias("n"), F.max("id").alias("most"))
        finish(c.start_table(observed, f"{root}/{name}", f"{root}/cp_{name}", name=name, trigger=NOW))
    log.close()
    rows = sorted(log.read().collect(), key=lambda r: r.batch)
    assert [(r.query, r.batch, r.input_rows, r.metrics) for r in rows] == [
        ("logged", n, n + 1, {"seen.n": n + 1, "seen.most": n}) for n in range(3)
    ]


def test_kafka_offsets(spark):
    """Offsets as Spark's Kafka source reports them."""
    rows = [
        (datetime(2024, 1, 1), "q", '{"t":{"0":5,"1":7},"u":{"0":1}}', '{"t":{"0":9,"1":7},"u":{"0":4}}'),
        (datetime(2024, 1, 2), "q", '{"t":{"0":9}}', None),
    ]
    progress = spark.createDataFrame(rows, "ts timestamp, query string, end_offset string, latest_offset string")
    got = {(r.ts.day, r.group, r.topic, r.partition, r.end_offset, r.committed) for r in kafka_offsets(progress).collect()}
    assert got == {
        (1, "q", "t", 0, 9, 5), (1, "q", "t", 1, 7, 7), (1, "q", "u", 0, 4, 1), (2, "q", "t", 0, 9, 9),
    }


def test_metric_log_replaces_a_batch(spark, tmp_path):
    log = MetricLog(str(tmp_path / "m"))
    log.save(spark, 0, a=1)
    log.save(spark, 0, a=2, b=3)
    assert {(r.batch, r.metric, r.value) for r in log.read(spark).collect()} == {(0, "a", 2), (0, "b", 3)}


def test_backlog_by_files_of_a_bounded_size(spark, sf, monkeypatch):
    """More files make more micro-batches, and the backlog after a topic's batch stays what it is."""
    written = []
    publish = catalog.StoredTopics.publish

    def counted(self, spark, topic, batch_id, producer):
        written.append(len(glob.glob(self._staged(topic, batch_id, producer) + "/*.parquet")))
        return publish(self, spark, topic, batch_id, producer)

    monkeypatch.setattr(catalog, "RECORDS_PER_FILE", 90, raising=False)
    monkeypatch.setattr(catalog.StoredTopics, "publish", counted)
    frame = catalog.QUERIES["consumer_lag_live"](spark, sf)
    assert len(written) == 6 and min(written) >= 1 and sum(written) > 6
    assert not compare(frame, connect(sf), ORACLES["consumer_lag_live"])


def test_seeded_stream_reads_files_of_many_tasks(spark, sf, tmp_path, monkeypatch):
    """The parts of the stream are not written by one task each."""
    spark.read.parquet(f"{sf}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    folders = {}
    monkeypatch.setattr(
        catalog, "work_dir", lambda spark, name: folders.setdefault(name, f"{tmp_path}/{name}")
    )
    frame = catalog.QUERIES["stream_cooldown_seeded"](spark, str(tmp_path))
    assert not compare(frame, connect(sf), ORACLES["stream_cooldown_seeded"])
    assert len(glob.glob(folders["candidates"] + "/*.parquet")) > 4
