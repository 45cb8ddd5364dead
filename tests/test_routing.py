import json
from datetime import datetime

from pyspark.sql import functions as F

from sensorloom.functions.sampling import sampled
from sensorloom.operators.ranking import number_rows
from sensorloom.operators.routing import (
    allocate_new,
    assign_partition,
    error_json,
    json_string,
    region_map,
)
from sensorloom.sources import drops
from sensorloom.sources.drops import new_files, read_drops
from sensorloom.sources.topics import KafkaTopics, StoredTopics


def test_new_locations_in_first_seen_order(spark):
    rows = [("Jeju", 9), ("Busan", 3), ("Dallas", 1), ("Busan", 20), ("Seoul", None)]
    seen = spark.createDataFrame(
        [(l, None if m is None else datetime(2024, 1, 1, 0, m)) for l, m in rows],
        "location string, event_time timestamp",
    )
    fresh = allocate_new(seen, region_map(spark))
    assert {(r.location, r.partition) for r in fresh.collect()} == {("Busan", 0), ("Jeju", 1), ("Seoul", 2)}


def test_region_map_files(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text('{"Paris": 0, "Los Angeles": 1}')
    bad.write_text("{not json")
    found = {(r.location, r.partition) for r in region_map(spark, str(good)).collect()}
    assert found == {("Paris", 0), ("Los Angeles", 1)}
    assert region_map(spark, str(bad)).count() == 0
    assert region_map(spark, str(tmp_path / "none.json")).count() == 0


def test_unknown_location_has_no_partition_yet(spark):
    rows = spark.createDataFrame([("Dallas",), ("Busan",)], "location string")
    assert {tuple(r) for r in assign_partition(rows, region_map(spark)).collect()} == {("Dallas", 5), ("Busan", None)}


def test_row_numbers(spark):
    rows = spark.range(2000).select(
        "id", F.timestamp_seconds((F.col("id") * 7919) % 500_000).alias("t")
    )
    got = {r.id: r.n for r in number_rows(rows, ["t", "id"], "t", "n").collect()}
    ordered = sorted(range(2000), key=lambda i: ((i * 7919) % 500_000, i))
    assert got == {i: n for n, i in enumerate(ordered)}


def test_sampling_is_stable_and_near_its_rate(spark):
    rows = spark.range(20_000)
    first = {r.id for r in rows.where(sampled(0.2, "s", "id")).collect()}
    again = {r.id for r in rows.repartition(7).where(sampled(0.2, "s", "id")).collect()}
    other = {r.id for r in rows.where(sampled(0.2, "t", "id")).collect()}
    assert first == again != other
    assert 0.18 < len(first) / 20_000 < 0.22
    assert rows.where(sampled(0.0, "s", "id")).count() == 0
    assert rows.where(sampled(1.0, "s", "id")).count() == 20_000


def test_envelope_is_json(spark):
    row = spark.range(1).select(
        error_json(
            F.lit("TYPE_ERROR"), F.lit("it's \"bad\""), json_string(F.lit('a "b"\n')), F.lit("f.csv"), F.lit(2)
        ).alias("v")
    )
    assert json.loads(row.first().v) == {
        "error_type": "TYPE_ERROR",
        "error_reason": 'it\'s "bad"',
        "raw_row": 'a "b"\n',
        "file_name": "f.csv",
        "retry_count": 2,
    }


def test_drop_files(spark, tmp_path):
    head = "Date_Time,Location,Temperature_C,Humidity_pct,Precipitation_mm,Wind_Speed_kmh\n"
    (tmp_path / "a.csv").write_text(
        head.replace("Date_Time,Location", "Location,Date_Time")
        + '"Los Angeles",2024-01-01 00:00:00,1.5,"",,4\nDallas,2024-01-01 00:00:00,2\n',
        encoding="utf-8",
    )
    (tmp_path / "note.txt").write_text("no drop file")
    rows = {r.location: r for r in read_drops(spark, str(tmp_path)).collect()}
    assert set(rows) == {"Los Angeles", "Dallas"}
    full, short = rows["Los Angeles"], rows["Dallas"]
    assert (full.humidity_pct, full.precipitation_mm, full.wind_speed_kmh) == ("", None, "4")
    assert short.wind_speed_kmh is None and short.file_name == "a.csv"
    assert full.file_name == "a.csv"


def test_columns_are_found_by_the_header(spark, tmp_path):
    files = {
        "order.csv": "Date_Time,Location,Wind_Speed_kmh,Temperature_C,Humidity_pct,Precipitation_mm\n"
        '2024-01-01 00:00:00,"Da ""x"" llas",1,2,3,4\n',
        "more.csv": "Station,Location,Date_Time,Temperature_C,Humidity_pct,Precipitation_mm,Wind_Speed_kmh,Note\n"
        'S1,Houston,2024-01-01 00:00:00,2,3,4,1,"a, b"\n',
        "less.csv": "Location,Date_Time,Temperature_C,Precipitation_mm,Wind_Speed_kmh\nPhoenix,2024-01-01 00:00:00,2,4,1\n",
        "none.csv": "a,b\n1,2\n",
        "head.csv": "Location,Date_Time,Temperature_C,Humidity_pct,Precipitation_mm,Wind_Speed_kmh\n",
        "empty.csv": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = {r.file_name: r for r in read_drops(spark, str(tmp_path)).collect()}
    numbers = {n: (r.temperature_c, r.humidity_pct, r.precipitation_mm, r.wind_speed_kmh) for n, r in rows.items()}
    assert numbers == {
        "order.csv": ("2", "3", "4", "1"),
        "more.csv": ("2", "3", "4", "1"),
        "less.csv": ("2", None, "4", "1"),
        "none.csv": (None, None, None, None),
    }
    assert rows["order.csv"].location == 'Da "x" llas' and rows["none.csv"].location is None


def test_headers_are_read_from_the_first_block_once(spark, tmp_path):
    head = "Location,Date_Time,Temperature_C,Humidity_pct,Precipitation_mm,Wind_Speed_kmh"
    folder, index = tmp_path / "drops", str(tmp_path / "index")
    folder.mkdir()
    wide = ",".join(f"note{n:05}" for n in range(9000))  # a header of more than one block
    texts = {
        "a b.csv": f"{head}\nDallas,t,1,2,3,4\n{head}\n",  # the header again, as data
        "late.csv": f"x,y\n{head}\nDallas,t,1,2,3,4\n",  # not the first line
        "bom.csv": f"\ufeff\r\n{head}\r\nHouston,t,1,2,3,4\r\n",
        "wide.csv": f"{wide},{head}\n" + "," * 9000 + "Phoenix,t,1,2,3,4\n",
    }
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    rows = read_drops(spark, str(folder), index=index).collect()
    places = sorted((r.file_name.replace("%20", " "), r.location or "") for r in rows)
    assert places == [
        ("a b.csv", "Dallas"), ("a b.csv", "Location"), ("bom.csv", "Houston"),
        ("late.csv", ""), ("late.csv", ""), ("wide.csv", "Phoenix"),
    ]
    # Files of the index are not opened again: their headers stay what they were.
    (folder / "late.csv").write_text(f"{head}\nDallas,t,1,2,3,4\n")
    (folder / "new.csv").write_text(f"{head}\nMiami,t,1,2,3,4\n")
    groups = {g.header: len(g.paths) for g in drops.headers(drops._files(spark.read, str(folder)), index)}
    assert groups[head] == 3 and groups[None] == 1 and sum(groups.values()) == 5
    assert spark.read.parquet(index).count() == 5


def test_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Location,Date_Time,Temperature_C,Humidity_pct,Precipitation_mm,Wind_Speed_kmh\n"
        '"two\nlines",2024-01-01 00:00:00,1,2,3,4\n',
        encoding="utf-8",
    )
    rows = read_drops(spark, str(tmp_path), multi_line=True).collect()
    assert [r.location for r in rows] == ["two\nlines"]


def test_a_small_rate_is_not_none(spark):
    rows = spark.range(1, 200_000).withColumn("hit", sampled(1e-4, "s", "id"))
    assert 5 <= rows.where("hit").count() <= 45
    text = rows.select(sampled(1e-12, "s", "id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "< 1)" in text


def test_new_files(spark):
    listing = spark.createDataFrame([("a",), ("b",)], "file_name string")
    done = spark.createDataFrame([("a",), ("z",)], "file_name string")
    assert [r[0] for r in new_files(listing, done).collect()] == ["b"]


def test_kafka_options():
    topics = KafkaTopics("h1:9092,h2:9092", {"kafka.request.timeout.ms": "60000"})
    assert topics.source_options("weather-data") == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "weather-data",
        "startingOffsets": "latest",
        "kafka.request.timeout.ms": "60000",
    }
    limited = topics.source_options("error-data", "earliest", 2000)
    assert limited["maxOffsetsPerTrigger"] == "2000" and limited["startingOffsets"] == "earliest"


def test_stored_topic_replaces_a_batch(spark, tmp_path):
    topics = StoredTopics(str(tmp_path), partitions=3)
    rows = spark.createDataFrame([("k", "1", 2), ("k", "2", None)], "key string, value string, partition int")
    for batch in (0, 1, 1):
        topics.write(rows, "t", batch, "p")
    topics.write(rows, "t", 1, "q")
    stored = topics.read(spark, "t").collect()
    assert len(stored) == 6 and all(r.topic == "t" and 0 <= r.partition < 3 for r in stored)
    assert len({(r.producer, r.batch, r.offset) for r in stored}) == 6
    assert topics.read(spark, "t", from_batch=1).count() == 4


def test_jdbc_options():
    from sensorloom.sources.tables import JdbcTable

    table = JdbcTable("jdbc:postgresql://h/db", "errors", {"user": "u"})
    assert table.read_options() == {
        "url": "jdbc:postgresql://h/db",
        "dbtable": "errors",
        "fetchsize": "10000",
        "user": "u",
    }
    split = table.read_options("id", "0", "1000", 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "1000", "8",
    )
