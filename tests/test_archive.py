import glob
import os
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorloom.operators.alerts import find_alerts, store_alerts, write_alerts
from sensorloom.operators.archive import (
    DailySummaries,
    archive_rows,
    daily_summary,
    read_archive,
    refresh_daily_summary,
    write_archive,
)
from sensorloom.operators.slices import in_range, time_span, with_slice, write_slices
from sensorloom.operators.windows import collect_windows, window_counts
from sensorloom.schemas import ALERTS_TABLE
from sensorloom.sources.events import raw_readings, timed_readings
from sensorloom.operators.validate import valid_readings


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_per_file_and_pruning(spark, sf, tmp_path):
    path = str(tmp_path / "archive")
    rows = archive_rows(valid_readings(raw_readings(spark, sf)))
    write_archive(rows, path, rows_per_file=2)
    files = glob.glob(f"{path}/location=*/date=*/*.parquet")
    assert files and max(pq.read_metadata(f).num_rows for f in files) <= 2
    stored = read_archive(spark, path)
    assert stored.count() == rows.count()
    one = stored.where((F.col("location") == "Dallas") & (F.col("date") == "2024-01-03")).select("temperature_c")
    text = plan(one)
    assert "PartitionFilters: [" in text and "location" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<temperature_c:double>" in text
    expected = rows.where((F.col("location") == "Dallas") & (F.col("date") == date(2024, 1, 3)))
    assert one.count() == expected.count() > 0


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    """Half of all rows lie in one folder; rebalancing splits it."""
    path = str(tmp_path / "hot")
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("L"), F.col("id") % 5)).alias("location"),
        F.lit(date(2024, 1, 1)).alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        write_archive(rows, path, rows_per_file=0)
    finally:
        spark.conf.set(name, before)
    assert len(glob.glob(f"{path}/location=hot/date=*/*.parquet")) > 1
    assert spark.read.parquet(path).count() == 60_000


def test_summary_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "daily")

    def rows(day, temperatures):
        return spark.createDataFrame(
            [("A", date(2024, 1, day), float(t), 1.0, 2.0) for t in temperatures],
            "location string, date date, temperature_c double, precipitation_mm double, wind_speed_kmh double",
        )

    first, second = rows(1, [1, 3]), rows(2, [5])
    refresh_daily_summary(first.unionByName(second), first.unionByName(second), path)
    # A part of a day comes later: the whole day is summed again, and only that day.
    later = rows(1, [8]).withColumn("location", F.lit("B"))
    archive = first.unionByName(later).unionByName(rows(2, [70]))
    refresh_daily_summary(archive, later, path)
    found = {(r.location, r.date.day): r.avg_temperature for r in spark.read.parquet(path).collect()}
    assert found == {("A", 1): 2.0, ("B", 1): 8.0, ("A", 2): 5.0}


def test_summary_keeps_every_finite_number(spark):
    def summary(*numbers):
        rows = [("A", date(2024, 1, 1), t, t, 2.0) for t in numbers]
        return daily_summary(spark.createDataFrame(
            rows, "location string, date date, temperature_c double, precipitation_mm double, wind_speed_kmh double"
        )).first()

    assert summary(1.0, 1e15).total_precipitation == 1e15 + 1
    assert summary(20.00004, 20.00004).avg_temperature == 20.00004
    assert summary(1e300, 1.0).total_precipitation == 1e300
    assert summary(1e-300, float("inf")).total_precipitation == 1e-300
    assert summary(float("nan")).avg_temperature is None


def test_summary_survives_numbers_that_are_not_finite(spark):
    rows = spark.createDataFrame(
        [("A", date(2024, 1, 1), t, 1.0, 2.0) for t in (float("nan"), 2.0, 4.0)],
        "location string, date date, temperature_c double, precipitation_mm double, wind_speed_kmh double",
    )
    row = daily_summary(rows).first()
    assert (row.n_readings, row.avg_temperature) == (3, 3.0)


def test_alert_table_pruning(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts = spark.range(100).select(
        F.col("id").cast("string").alias("alert_id"),
        F.lit("A").alias("location"),
        F.lit("T").alias("alert_type"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("event_time"),
        (F.col("id") % 2 == 0).alias("slack_sent"),
    )
    rest = {"alert_reason": "string", "value": "double", "threshold": "double", "raw_json": "string",
            "slack_sent_at": "timestamp", "retry_count": "int"}
    alerts = alerts.withColumns({c: F.lit(None).cast(kind) for c, kind in rest.items()})
    write_alerts(alerts, path)
    since = F.lit(datetime(2024, 1, 2))
    stored = spark.read.parquet(path)
    assert set(stored.columns) == {*ALERTS_TABLE.fieldNames(), "date"}
    found = find_alerts(stored, since=since, locations=["A"], alert_types=["T"], sent=False)
    text = plan(found)
    pushed = text.split("PushedFilters:")[1].split("]")[0]
    assert all(c in pushed for c in ("event_time", "location", "slack_sent"))
    assert "date" in text.split("PartitionFilters:")[1].split("]")[0]
    assert found.count() == 38


def test_alerts_that_break_the_contract(spark, tmp_path):
    row = ("1", None, "T", "why", datetime(2024, 1, 1), 1.0, 1.0, False, None, 0, "{}")
    schema = ("alert_id string, location string, alert_type string, alert_reason string, event_time timestamp, "
              "value double, threshold double, slack_sent boolean, slack_sent_at timestamp, retry_count int, raw_json string")
    alerts = spark.createDataFrame([row, ("2", "A", *row[2:])], schema)
    path, bad = str(tmp_path / "alerts"), str(tmp_path / "bad")
    with pytest.raises(Exception, match="location is null"):
        write_alerts(alerts, path)
    write_alerts(alerts, path, quarantine=bad, mode="overwrite")
    assert [r.alert_id for r in spark.read.parquet(path).collect()] == ["2"]
    assert [(r.alert_id, r.violation) for r in spark.read.parquet(bad).collect()] == [("1", "location is null")]


def test_slices(spark, sf, tmp_path):
    timed = timed_readings(spark, sf)
    path = str(tmp_path / "slices")
    sliced = with_slice(timed, 86_400)
    shuffled = sliced.orderBy(F.rand(1))
    columns = ("location", "date_time", "slice_start", "slice_name")
    write_slices(shuffled.select(*columns), path, time="date_time")
    for file in glob.glob(f"{path}/slice_name=*/*.csv"):
        times = [line.split(",")[1] for line in open(file, encoding="utf-8").read().splitlines()[1:]]
        assert times == sorted(times) and times
    names = {os.path.basename(p).split("=")[1] for p in glob.glob(f"{path}/slice_name=*")}
    assert names == {r[0] for r in sliced.select("slice_name").distinct().collect()}
    assert spark.read.option("header", True).csv(path).count() == timed.count()
    span = time_span(timed).first()
    first = sliced.agg(F.min("slice_start")).first()[0]
    assert first == span.start_time and first.second == 0
    half = datetime(2024, 1, 10)
    assert in_range(timed, datetime(2024, 1, 1), half).count() == timed.where(F.col("event_time") < half).count()


def test_collected_windows_keep_every_row(spark, sf):
    timed = timed_readings(spark, sf).select("event_id", "location", "event_time")
    whole = collect_windows(timed, "1 day")
    assert whole.groupBy("window", "location").count().where("count > 1").isEmpty()
    collected = collect_windows(timed, "1 day", rows_per_array=2)
    assert collected.agg(F.max("part")).first()[0] > 0
    counts = {
        (r.window.start, r.location): r.n
        for r in collected.groupBy("window", "location").agg(F.sum(F.size("rows")).alias("n")).collect()
    }
    expected = {(r.window_start, r.location): r.n_rows for r in window_counts(timed, "1 day", "location").collect()}
    assert counts == expected


READINGS = "location string, date date, temperature_c double, precipitation_mm double, wind_speed_kmh double"


def test_parts_of_days_are_merged(spark, tmp_path):
    """Any split into batches gives what all rows at once give, exact or not, rolled up or not."""
    numbers = [0.1, 0.2, 1e15, -1e15, 0.3, float("nan"), None, 20.000125, 1e300, float("inf"), -5.5]
    cells = [(loc, date(2024, 1, 1 + n % 2), t) for loc in "AB" for n, t in enumerate(numbers)]
    cells = [c for c in cells if c[0] == "B" or c[2] is None or abs(c[2]) < 1e20]
    rows = spark.createDataFrame([(*c, c[2], c[2]) for c in cells], READINGS).withColumn(
        "n", F.monotonically_increasing_id()
    )
    days = DailySummaries(str(tmp_path))
    for n in range(4):
        days.add(rows.where(F.pmod(F.xxhash64("n"), F.lit(4)) == n), n)
    days.add(rows.where(F.pmod(F.xxhash64("n"), F.lit(4)) == 3), 3)

    def cells_of(frame):
        return sorted(str(tuple(r[c] for c in sorted(r.asDict()))) for r in frame.collect())

    want = cells_of(daily_summary(rows))
    assert cells_of(days.read(spark)) == want
    days.roll_up(spark, 1)
    assert cells_of(days.read(spark)) == want and days.rolled(spark) == 1
    days.roll_up(spark, 3)
    days.roll_up(spark, 2)
    days.add(rows, 2)  # a batch that is in already
    assert cells_of(days.read(spark)) == want and days.rolled(spark) == 3


def test_reading_summaries_does_not_read_the_archive(spark, tmp_path):
    days = DailySummaries(str(tmp_path / "days"))
    rows = spark.createDataFrame([("A", date(2024, 1, 1), 1.0, 2.0, 3.0)], READINGS)
    rows.write.parquet(str(tmp_path / "archive"))
    days.add(spark.read.parquet(str(tmp_path / "archive")), 0)
    assert days.read(spark).inputFiles() and not any("/archive/" in f for f in days.read(spark).inputFiles())


def test_lookups_skip_row_groups(spark, tmp_path):
    """Rows of a date lie by location and type: a lookup opens few of its row groups."""
    path = str(tmp_path / "alerts")
    n = F.col("id")
    alerts = spark.range(40_000).select(
        F.sha2(n.cast("string"), 256).alias("alert_id"),
        F.concat(F.lit("L"), F.lpad((n * 7 % 40).cast("string"), 2, "0")).alias("location"),
        F.concat(F.lit("T"), F.floor(n / 40) % 4).alias("alert_type"),
        F.timestamp_seconds(F.lit(1704067200) + n % 86400).alias("event_time"),
        F.lit(False).alias("slack_sent"),
    )
    rest = {"alert_reason": "string", "value": "double", "threshold": "double", "raw_json": "string",
            "slack_sent_at": "timestamp", "retry_count": "int", "created_at": "timestamp"}
    alerts = alerts.withColumns({c: F.lit(None).cast(kind) for c, kind in rest.items()})
    store_alerts(alerts.select(*ALERTS_TABLE.fieldNames()), path, row_group_bytes=64 << 10)
    groups = []
    for name in glob.glob(f"{path}/date=*/*.parquet"):
        meta = pq.read_metadata(name)
        column = meta.schema.names.index("location")
        groups += [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
    hit = [g for g in groups if g.min <= "L07" <= g.max]
    assert len(groups) >= 10 and len(hit) <= len(groups) / 4

    def rows_read(frame):
        frame._jdf.collectToPython()
        leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()

    stored = spark.read.parquet(path)
    by_location = find_alerts(stored, locations=["L07"])
    both = find_alerts(stored, locations=["L07"], alert_types=["T2"])
    assert by_location.count() == 1000 and both.count() == 250
    assert rows_read(by_location) < 10_000
    assert rows_read(both) <= rows_read(by_location)
    # An id that is not there: every row group's bloom filter says so.
    assert rows_read(stored.where(F.col("alert_id") == F.sha2(F.lit("no such"), 256))) < 20_000
