"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import (
    event_time_lenient,
    event_time_strict,
    iso_text,
    iso_time,
    or_unknown,
    parse_float,
    parse_int_or_zero,
)
from ..functions.sampling import sampled
from ..functions.text import alert_text, error_text, retry_text
from ..functions.once import once
from ..operators.alerts import (
    alert_counts,
    alert_rows,
    carried_json,
    distinct_alerts,
    find_alerts,
    write_alerts,
)
from ..operators.archive import (
    DailySummaries,
    archive_layout,
    archive_rows,
    daily_summary,
    read_archive,
    write_archive,
)
from ..operators.compaction import CompactedArchive
from ..operators.cooldown import cooldown, latest_alerts
from ..operators.deadletter import error_rows, record_id
from ..operators.metrics import (
    consumer_lag,
    latest_offsets,
    rate_steps,
    topic_list,
    topic_rates,
    topic_throughput,
)
from ..operators.outbox import Outbox, Schedule, apply_acks, unsent_batch
from ..operators.retry import (
    FAIL_SALT,
    decode_message,
    retry_alerts,
    retry_dead_letters,
    retry_republish,
    with_failure,
)
from ..operators.routing import (
    allocate_new,
    assign_partition,
    decode_readings,
    is_diverted,
    reading_fields,
    reading_json,
    region_map,
    to_error_records,
    to_reading_records,
)
from ..operators.rules import (
    ALERT_PROFILE,
    RETRY_PROFILE,
    describe_alerts,
    detect_alerts,
    detect_candidates,
    detect_either,
)
from ..operators.slices import in_range, time_span, with_slice
from ..operators.validate import (
    file_counts,
    float_error,
    missing_field,
    rejected_readings,
    type_error,
    valid_readings,
)
from ..operators.windows import collect_windows, window_counts, with_window, without_time
from ..constants import (
    ARCHIVE_ROWS_PER_FILE,
    DIVERT_RATE,
    REQUIRED_FIELDS,
    RETRY_FAIL_RATE,
    TOPIC_READINGS,
)
from ..session import prepare, work_dir
from ..sources.drops import new_files, read_drops, stream_drops, write_drops
from ..sources.events import raw_readings, retry_messages, table, timed_readings
from ..sources.topics import StoredTopics, position_of
from ..streaming.consumers import (
    AlertState,
    read_window_counts,
    start_alerts,
    start_archive,
    start_table,
    start_window_counts,
    window_counts_stream,
)
from ..streaming.cooldown import start_cooldown, stream_cooldown
from ..streaming.ingest import RegionTable, start_ingest
from ..streaming.observed import MetricLog, ProgressLog, counted_offsets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _flat(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _flat(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        return run

    return register


# Records that one task writes to one file of a topic where a stream takes file by file.
RECORDS_PER_FILE = 500_000

_READING = ("location", "date_time", "temperature_c", "humidity_pct", "precipitation_mm", "wind_speed_kmh")


# --- scans and decoding -----------------------------------------------------------------------
@query("csv_scan")
def _csv_scan(spark, sf_dir):
    path = work_dir(spark, "drops")
    write_drops(raw_readings(spark, sf_dir), path)
    return read_drops(spark, path).select(*_READING)


@query("csv_scan_headers")
def _csv_scan_headers(spark, sf_dir):
    """Files with columns in another order, one more or one missing, and with quotes in a cell."""
    raw = raw_readings(spark, sf_dir).select("event_id", *_READING)
    names = {c: n for n, c in REQUIRED_FIELDS.items()}
    orders = [
        _READING,
        _READING[::-1],
        ("event_id", *_READING[3:], *_READING[:3]),
        tuple(c for c in _READING if c != "humidity_pct"),
    ]
    folder = work_dir(spark, "drops")
    for n, columns in enumerate(orders):
        rows = raw.where(F.col("event_id") % 4 == n)
        quoted = F.when(F.col("event_id") % 20 == 0, F.concat(F.lit('"The" '), "location", F.lit(", x")))
        rows = rows.withColumn("location", F.coalesce(quoted, "location"))
        wire = rows.select(*[F.col(c).alias(names.get(c, c)) for c in columns])
        writer = wire.write.mode("append").option("header", "true").option("emptyValue", '""')
        writer.option("escape", '"').csv(folder)
    return read_drops(spark, folder).select(*_READING)


@query("new_files_anti")
def _new_files_anti(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    day = F.substring("file_name", 15, 2).cast("int")
    listing = raw.select("file_name").distinct()
    return new_files(listing, listing.where(day % 2 == 0))


def _reading_records(spark, sf_dir):
    """Readings as records; locations that are new get their partition in first-seen order."""
    valid = valid_readings(raw_readings(spark, sf_dir))
    valid = valid.withColumn("event_time", event_time_lenient("date_time"))
    known = region_map(spark)
    regions = known.unionByName(allocate_new(valid, known))
    return to_reading_records(valid, regions, "event_id")


@query("topic_encode")
def _topic_encode(spark, sf_dir):
    return _reading_records(spark, sf_dir)


@query("topic_decode")
def _topic_decode(spark, sf_dir):
    return decode_readings(_reading_records(spark, sf_dir), "event_id")


@query("topic_read_from")
def _topic_read_from(spark, sf_dir):
    """A stored topic in three batches, read from the second on."""
    topics = StoredTopics(work_dir(spark, "topics"))
    records = _reading_records(spark, sf_dir)
    for batch in range(3):
        topics.write(records.where(F.col("event_id") % 3 == batch), TOPIC_READINGS, batch, "ingest")
    return decode_readings(topics.read(spark, TOPIC_READINGS, from_batch=1))


@query("range_filter")
def _range_filter(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-05 12:00:00", "2024-01-08"))
    return in_range(timed_readings(spark, sf_dir), start, end).select("event_id", "event_time")


@query("time_span")
def _time_span(spark, sf_dir):
    return time_span(timed_readings(spark, sf_dir))


def _odd_messages(spark, sf_dir):
    """Reading messages, some cut short and some with a number written as text."""
    valid = valid_readings(raw_readings(spark, sf_dir)).withColumn("value", reading_json())
    value, event_id = F.col("value"), F.col("event_id")
    return valid.select(
        "event_id",
        F.when(event_id % 17 == 0, F.substring(value, 1, 25))
        .when(event_id % 19 == 0, F.regexp_replace(value, r'("Humidity_pct":)([^,]*)', '$1"$2"'))
        .otherwise(value)
        .alias("value"),
    )


@query("json_decode_fixed")
def _json_decode_fixed(spark, sf_dir):
    return decode_readings(_odd_messages(spark, sf_dir), "event_id")


@query("json_decode_dynamic")
def _json_decode_dynamic(spark, sf_dir):
    decoded = decode_message(retry_messages(spark, sf_dir), "event_id")
    return decoded.select(
        "event_id",
        "location",
        "temperature_c",
        "precipitation_mm",
        "wind_speed_kmh",
        (~F.col("_without_temperature")).alias("has_temperature"),
        "event_time",
    )


@query("json_encode")
def _json_encode(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    nulls = {c: F.nullif(F.col(c), F.lit("")) for c in ("location", "temperature_c")}
    return raw.withColumns(nulls).withColumn("retry", F.lit(0)).select("event_id", reading_json().alias("value"))


# --- expressions ------------------------------------------------------------------------------
@query("default_location")
def _default_location(spark, sf_dir):
    return raw_readings(spark, sf_dir).select("event_id", or_unknown("location").alias("location"))


@query("coerce_float")
def _coerce_float(spark, sf_dir):
    return raw_readings(spark, sf_dir).select(
        "event_id",
        parse_float("temperature_c").alias("temperature"),
        float_error("Temperature_C", "temperature_c").alias("temperature_error"),
        parse_float("humidity_pct").alias("humidity"),
        float_error("Humidity_pct", "humidity_pct").alias("humidity_error"),
    )


@query("coerce_int_default")
def _coerce_int_default(spark, sf_dir):
    return raw_readings(spark, sf_dir).select(
        "event_id",
        parse_int_or_zero("wind_speed_kmh").alias("wind"),
        parse_int_or_zero("temperature_c").alias("temperature"),
    )


def _time_texts(spark, sf_dir):
    """Date texts in the spellings that consumers treat differently."""
    ts, event_id = F.col("ts"), F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event_id % 97 == 0, F.lit("2024-99-99 99:99:99"))
        .when(event_id % 5 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(event_id % 5 == 2, F.date_format(ts, "yyyy-M-d H:m:s"))
        .when(event_id % 5 == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .alias("text"),
    )


@query("event_time_lenient")
def _event_time_lenient(spark, sf_dir):
    return _time_texts(spark, sf_dir).select("event_id", event_time_lenient("text").alias("event_time"))


@query("event_time_strict")
def _event_time_strict(spark, sf_dir):
    return _time_texts(spark, sf_dir).select("event_id", event_time_strict("text").alias("event_time"))


@query("iso_roundtrip")
def _iso_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    cut = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    texts = events.withColumn("cut", cut).select("event_id", iso_text("cut").alias("iso"))
    return texts.withColumn("event_time", iso_time("iso"))


@query("iso_spellings")
def _iso_spellings(spark, sf_dir):
    """One moment in the spellings that ISO texts come in."""
    ts, event_id = F.col("ts").cast("timestamp"), F.col("event_id")
    later = ts + F.expr("interval 9 hours")
    text = (
        F.when(event_id % 6 == 0, F.concat(F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00")))
        .when(event_id % 6 == 1, F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit("Z")))
        .when(event_id % 6 == 2, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(".0")))
        .when(event_id % 6 == 3, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(",000000999")))
        .when(event_id % 6 == 4, F.date_format(ts, "yyyyMMdd"))
        .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" ")))
    )
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return texts.select("event_id", iso_time("text").alias("event_time"))


@query("retry_increment")
def _retry_increment(spark, sf_dir):
    return decode_message(retry_messages(spark, sf_dir), "event_id").select("event_id", "retry_count")


# --- validation and routing -------------------------------------------------------------------
@query("validate_missing")
def _validate_missing(spark, sf_dir):
    return raw_readings(spark, sf_dir).select("event_id", missing_field().alias("missing_field"))


@query("validate_type")
def _validate_type(spark, sf_dir):
    return raw_readings(spark, sf_dir).select("event_id", type_error().alias("type_error"))


@query("route_valid")
def _route_valid(spark, sf_dir):
    return valid_readings(raw_readings(spark, sf_dir)).select("event_id", *_READING, "retry")


@query("route_errors")
def _route_errors(spark, sf_dir):
    return rejected_readings(raw_readings(spark, sf_dir)).select(
        "event_id", "error_type", "error_reason", or_unknown("location").alias("key"), "file_name"
    )


@query("error_envelopes")
def _error_envelopes(spark, sf_dir):
    rejected = rejected_readings(raw_readings(spark, sf_dir))
    return to_error_records(rejected, F.col("event_id").cast("double"), "event_id")


@query("file_counts")
def _file_counts(spark, sf_dir):
    return file_counts(raw_readings(spark, sf_dir))


@query("table_contract")
def _table_contract(spark, sf_dir):
    """Rows through the sink of the alerts table: what it took, and what went to quarantine."""
    rows = raw_readings(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("alert_id"),
        F.nullif("location", F.lit("")).alias("location"),
        F.when(F.col("event_id") % 31 == 0, F.repeat(F.lit("x"), F.lit(60)))
        .otherwise(F.lit("TEMP_HIGH"))
        .alias("alert_type"),
        event_time_lenient("date_time").alias("event_time"),
        F.lit(False).alias("slack_sent"),
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in (
                ("alert_reason", "string"), ("value", "double"), ("threshold", "double"),
                ("slack_sent_at", "timestamp"), ("retry_count", "int"), ("raw_json", "string"),
            )
        ],
    )
    path, quarantine = work_dir(spark, "alerts"), work_dir(spark, "quarantine")
    write_alerts(rows, path, quarantine)
    event_id = F.col("alert_id").cast("long").alias("event_id")
    taken = spark.read.parquet(path).select(event_id, F.lit(None).cast("string").alias("violation"))
    return taken.unionByName(spark.read.parquet(quarantine).select(event_id, "violation"))


@query("sample_retry")
def _sample_retry(spark, sf_dir):
    return timed_readings(spark, sf_dir).where(is_diverted("event_id", rate=DIVERT_RATE)).select("event_id")


@query("sample_fail")
def _sample_fail(spark, sf_dir):
    timed = timed_readings(spark, sf_dir)
    return timed.where(sampled(RETRY_FAIL_RATE, FAIL_SALT, "event_id")).select("event_id")


@query("assign_partition")
def _assign_partition(spark, sf_dir):
    valid = valid_readings(raw_readings(spark, sf_dir))
    return assign_partition(valid, region_map(spark)).select("event_id", "location", "partition")


@query("assign_new_partition")
def _assign_new_partition(spark, sf_dir):
    return allocate_new(timed_readings(spark, sf_dir), region_map(spark))


# --- alerts -----------------------------------------------------------------------------------
def _candidates(spark, sf_dir):
    return detect_candidates(
        timed_readings(spark, sf_dir), ALERT_PROFILE, "event_id", "location", "event_time"
    )


def _kept(spark, sf_dir, minutes=30, seed=None):
    return cooldown(_candidates(spark, sf_dir), minutes=minutes, seed=seed)


@query("detect_alerts")
def _detect_alerts(spark, sf_dir):
    valid = valid_readings(raw_readings(spark, sf_dir))
    return detect_alerts(valid, ALERT_PROFILE, "event_id", "location")


@query("detect_alerts_retry")
def _detect_alerts_retry(spark, sf_dir):
    decoded = decode_message(retry_messages(spark, sf_dir), "event_id")
    return detect_alerts(decoded, RETRY_PROFILE, "event_id", "location")


@query("drop_null_time")
def _drop_null_time(spark, sf_dir):
    valid = valid_readings(raw_readings(spark, sf_dir))
    timed = valid.withColumn("event_time", event_time_lenient("date_time"))
    return without_time(timed).groupBy("location").agg(F.count("*").alias("n_without_time"))


@query("cooldown_alerts")
def _cooldown_alerts(spark, sf_dir):
    return _kept(spark, sf_dir)


@query("cooldown_six_hours")
def _cooldown_six_hours(spark, sf_dir):
    return _kept(spark, sf_dir, minutes=360)


@query("cooldown_dense")
def _cooldown_dense(spark, sf_dir):
    """One key with an alert in every millisecond, over several units of blocks."""
    copies = 64
    rows = table(spark, sf_dir, "events").select(
        F.lit("Dallas").alias("location"),
        F.lit("TEMP_HIGH").alias("alert_type"),
        F.col("event_id"),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("n"),
    )
    alerts = rows.select(
        "location",
        "alert_type",
        (F.col("event_id") * copies + F.col("n")).alias("event_id"),
        F.timestamp_millis(1704067200000 + F.col("event_id") * copies + F.col("n")).alias("event_time"),
    )
    return cooldown(alerts, minutes=7 / 60_000, resolution=0.001)


@query("cooldown_seeded")
def _cooldown_seeded(spark, sf_dir):
    """The first days seed the cooldown of the rest."""
    alerts = _candidates(spark, sf_dir)
    border = F.lit("2024-01-11").cast("timestamp")
    seed = latest_alerts(cooldown(alerts.where(F.col("event_time") < border), minutes=90))
    return cooldown(alerts.where(F.col("event_time") >= border), minutes=90, seed=seed)


def _alert_rows(spark, sf_dir):
    """Rows of the alerts table, with the reading behind each."""
    reading = reading_fields(iso_text("event_time").alias("event_time"))
    readings = timed_readings(spark, sf_dir).withColumn("reading", reading)
    found = detect_candidates(
        readings, ALERT_PROFILE, "event_id", "location", "event_time", "reading"
    )
    return alert_rows(carried_json(cooldown(found)), ALERT_PROFILE)


@query("alerts_table")
def _alerts_table(spark, sf_dir):
    rows = _alert_rows(spark, sf_dir)
    # the same batch written twice leaves one row per alert
    return distinct_alerts(rows.unionByName(rows)).drop("slack_sent_at")


@query("alert_counts")
def _alert_counts(spark, sf_dir):
    return alert_counts(_kept(spark, sf_dir))


@query("alerts_by_filter")
def _alerts_by_filter(spark, sf_dir):
    path = work_dir(spark, "alerts")
    write_alerts(_alert_rows(spark, sf_dir), path)
    found = find_alerts(
        spark.read.parquet(path),
        since=F.lit("2024-01-10 06:00:00").cast("timestamp"),
        until=F.lit("2024-01-12 18:00:00").cast("timestamp"),
        locations=["Dallas", "Chicago"],
        alert_types=["RAIN_HEAVY", "TEMP_HIGH"],
        sent=False,
    )
    return found.select("alert_id", "location", "alert_type", "event_time", "value", "threshold")


@query("alerts_union")
def _alerts_union(spark, sf_dir):
    """Alerts of the readings that were not diverted, and retry alerts of those that were."""
    diverted = is_diverted("event_id", rate=DIVERT_RATE)
    timed = once(timed_readings(spark, sf_dir), diverted=diverted)
    keep = ("event_id", "location", "event_time", "diverted")
    found = detect_either(timed, "diverted", RETRY_PROFILE, ALERT_PROFILE, *keep)
    # One chain for both: the profile is a part of the key.
    kept = cooldown(found, keys=("diverted", "location", "alert_type"))
    counted = kept.withColumn("retry_count", F.col("diverted").cast("int"))
    return (
        alert_rows(counted.where("not diverted"), ALERT_PROFILE)
        .unionByName(alert_rows(counted.where("diverted"), RETRY_PROFILE))
        .drop("slack_sent_at", "raw_json")
    )


@query("render_alert")
def _render_alert(spark, sf_dir):
    alerts = with_window(describe_alerts(_kept(spark, sf_dir), ALERT_PROFILE))
    return alerts.select("event_id", "alert_type", alert_text().alias("text"))


# --- windows, slices, archive -----------------------------------------------------------------
@query("window_collect")
def _window_collect(spark, sf_dir):
    rows = timed_readings(spark, sf_dir).select("event_id", "location", "event_time", "temperature_c")
    collected = collect_windows(rows, "1 hour")
    return collected.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "location",
        "part",
        F.size("rows").cast("long").alias("n_rows"),
        F.array_min("rows.event_time").alias("first_time"),
        F.array_max("rows.event_time").alias("last_time"),
        F.array_min("rows.event_id").alias("least_id"),
        F.aggregate("rows.event_id", F.lit(0).cast("long"), lambda s, x: s + x).alias("sum_ids"),
        F.array_max("rows.temperature_c").alias("max_temperature"),
    )


@query("window_rows")
def _window_rows(spark, sf_dir):
    return with_window(timed_readings(spark, sf_dir)).select(
        "event_id", "location", "window_start", "window_end"
    )


@query("window_counts")
def _window_counts(spark, sf_dir):
    return window_counts(timed_readings(spark, sf_dir), "60 seconds", "location")


@query("time_slices")
def _time_slices(spark, sf_dir):
    sliced = with_slice(timed_readings(spark, sf_dir), 600)
    return sliced.groupBy("slice_name", "slice_start").agg(F.count("*").alias("n_rows"))


@query("archive_filter")
def _archive_filter(spark, sf_dir):
    texts = _time_texts(spark, sf_dir).withColumnRenamed("text", "date_time")
    rows = archive_rows(texts.withColumn("location", F.lit("")))
    return rows.select("event_id", "location", "event_time", "date")


@query("archive_layout")
def _archive_layout(spark, sf_dir):
    rows = archive_rows(valid_readings(raw_readings(spark, sf_dir)))
    return archive_layout(rows, ARCHIVE_ROWS_PER_FILE)


@query("archive_roundtrip")
def _archive_roundtrip(spark, sf_dir):
    path = work_dir(spark, "archive")
    write_archive(archive_rows(valid_readings(raw_readings(spark, sf_dir))), path)
    return archive_layout(read_archive(spark, path), ARCHIVE_ROWS_PER_FILE)


@query("archive_compacted")
def _archive_compacted(spark, sf_dir):
    """Rows and files per folder after a pass, a late delivery and another pass."""
    archive = CompactedArchive(work_dir(spark, "compacted"))
    rows = archive_rows(valid_readings(raw_readings(spark, sf_dir)))
    third = F.col("event_id") % 3
    for n in range(2):
        write_archive(rows.where(third == n), archive.fresh)
    archive.compact(spark)
    write_archive(rows.where((third == 2) & (F.col("location") != "Dallas")), archive.fresh)
    archive.compact(spark)
    held = archive.read(spark).groupBy("location", "date")
    return held.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("_metadata.file_path").alias("n_files"),
        F.sum("event_id").alias("sum_ids"),
    )


@query("daily_summary")
def _daily_summary(spark, sf_dir):
    return daily_summary(archive_rows(valid_readings(raw_readings(spark, sf_dir))))


@query("daily_summary_incremental")
def _daily_summary_incremental(spark, sf_dir):
    """Five batches, one of them twice, and a roll-up after the third."""
    rows = archive_rows(valid_readings(raw_readings(spark, sf_dir)))
    days = DailySummaries(work_dir(spark, "summaries"))
    for n in (0, 1, 1, 2, 3, 4):
        days.add(rows.where(F.col("event_id") % 5 == n), n)
        if n == 2:
            days.roll_up(spark, 2)
            days.add(rows.where(F.col("event_id") % 5 == 1), 1)  # late again, and in already
    return days.read(spark)


@query("daily_summary_wide")
def _daily_summary_wide(spark, sf_dir):
    """The same over numbers far apart: up to 1e15, and with six decimals."""
    rows = archive_rows(valid_readings(raw_readings(spark, sf_dir)))
    event_id = F.col("event_id")
    return daily_summary(
        rows.withColumns(
            {
                "temperature_c": F.when(event_id % 3 == 0, F.col("temperature_c").cast("int") + 0.000125)
                .when(event_id % 7 == 0, F.lit(float("nan")))
                .otherwise(F.col("temperature_c")),
                "precipitation_mm": F.when(event_id % 11 == 0, F.lit(1e15)).otherwise(
                    F.col("precipitation_mm")
                ),
            }
        )
    )


# --- retry and dead letters -------------------------------------------------------------------
def _judged(spark, sf_dir):
    decoded = decode_message(retry_messages(spark, sf_dir), "event_id")
    return with_failure(decoded, "event_id", fail_rate=RETRY_FAIL_RATE)


@query("retry_alerts")
def _retry_alerts(spark, sf_dir):
    judged = _judged(spark, sf_dir).withColumnRenamed("value", "reading")
    kept = retry_alerts(judged, "event_id", keep=("reading",))
    return alert_rows(carried_json(kept), RETRY_PROFILE, "event_id").drop("slack_sent_at")


@query("render_retry")
def _render_retry(spark, sf_dir):
    kept = retry_alerts(_judged(spark, sf_dir), "event_id")
    return describe_alerts(kept, RETRY_PROFILE).select(
        "event_id", "alert_type", retry_text().alias("text")
    )


@query("retry_dlq")
def _retry_dlq(spark, sf_dir):
    return retry_dead_letters(_judged(spark, sf_dir), "event_id")


@query("retry_republish")
def _retry_republish(spark, sf_dir):
    return retry_republish(_judged(spark, sf_dir), 3, "event_id").select(
        "event_id", "location", "retry_count", "value", "topic"
    )


def _errors(spark, sf_dir):
    """The error table of the rejected readings; a third of it was sent already."""
    rejected = rejected_readings(raw_readings(spark, sf_dir))
    records = to_error_records(rejected, F.col("event_id").cast("double"), "event_id")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("created_at"))
    rows = error_rows(records, "event_id").join(events, "event_id")
    return rows.withColumnRenamed("event_id", "id").withColumn("slack_sent", F.col("id") % 3 == 0)


@query("dlq_load")
def _dlq_load(spark, sf_dir):
    rejected = rejected_readings(raw_readings(spark, sf_dir))
    direct = to_error_records(rejected, F.col("event_id").cast("double"), "event_id")
    failed = retry_dead_letters(_judged(spark, sf_dir), "event_id")
    records = direct.select("event_id", "key", "value").unionByName(
        failed.select("event_id", "key", "value")
    )
    # The columns of Spark's Kafka source, where key and value are bytes.
    received = records.select(
        "event_id",
        F.encode("key", "UTF-8").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        F.lit("error-data").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_seconds("event_id").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows = error_rows(received, "event_id", *position_of(received))
    named = rows.withColumn("id", record_id(*position_of(received)))
    return named.drop(*position_of(received), "slack_sent_at")


# --- outbox -----------------------------------------------------------------------------------
@query("outbox_top10")
def _outbox_top10(spark, sf_dir):
    return unsent_batch(_errors(spark, sf_dir)).select(
        "id", "error_type", "error_message", "location", "file_name", "raw_row", "created_at"
    )


@query("render_error")
def _render_error(spark, sf_dir):
    return _errors(spark, sf_dir).select("id", error_text().alias("text"))


@query("outbox_ack")
def _outbox_ack(spark, sf_dir):
    errors = _errors(spark, sf_dir)
    acks = errors.where(F.col("id") % 5 == 0).select(
        "id", (F.col("created_at") + F.expr("interval 1 minute")).alias("sent_at")
    )
    return apply_acks(errors, acks).select("id", "slack_sent", "slack_sent_at")


def _accepts_type_errors(text: str) -> bool:
    """A sender without a network: type errors go out, missing fields fail."""
    return "TYPE_ERROR" in text


def _accepts_heat(text: str) -> bool:
    return "TEMP HIGH" in text


def _drained(spark, rows, render, sender, id_column, order):
    """The send state after two cycles over a stored table, with the log compacted in between."""
    box = Outbox(work_dir(spark, "outbox_table"), id_column, order)
    box.add(rows)
    moment = F.lit("2024-02-01").cast("timestamp")
    box.drain_once(spark, render, sender, sent_at=moment)
    box.compact(spark)
    box.drain_once(spark, render, sender, sent_at=moment)
    return box.state(spark).select(id_column, "slack_sent", "slack_sent_at")


@query("outbox_cycle")
def _outbox_cycle(spark, sf_dir):
    return _drained(
        spark, _errors(spark, sf_dir), error_text(), _accepts_type_errors, "id", "created_at"
    )


@query("alert_outbox_cycle")
def _alert_outbox_cycle(spark, sf_dir):
    """The same cycles over the alerts table."""
    alerts = with_window(alert_rows(_kept(spark, sf_dir), ALERT_PROFILE))
    return _drained(spark, alerts, alert_text(), _accepts_heat, "alert_id", "event_time")


def _never_sent(text: str) -> bool:
    return int(text.split("|")[0]) not in range(0, 211 * 15, 211)


@query("outbox_poison")
def _outbox_poison(spark, sf_dir):
    """Two drainers in turn; the rows of ten ids always fail, and keep none of the others waiting.

    A call sends half of what is due, in turns of 250 rows, and leaves the rest to the other drainer.
    """
    path = work_dir(spark, "outbox_poison")
    boxes = [Outbox(path, schedule=Schedule(base=3600.0)) for _ in range(2)]
    boxes[0].add(_errors(spark, sf_dir))
    moment = F.lit("2024-02-01").cast("timestamp")
    render = F.concat_ws("|", "id", error_text())
    n = 0
    while boxes[n % 2].drain_once(spark, render, _never_sent, limit=250, sent_at=moment, share=0.5):
        n += 1
    later = moment + F.expr("interval 61 minutes")
    again = boxes[0].drain_once(spark, render, _never_sent, limit=250, sent_at=later)
    outcomes = boxes[0].outcomes(spark)
    state = boxes[0].state(spark).select("id", "slack_sent").join(outcomes, "id", "left")
    return state.fillna(0).withColumn("n_due_again", F.lit(again).cast("long"))


# --- metrics ----------------------------------------------------------------------------------
def _topic_name():
    n = F.col("event_id") % 10
    return F.when(n == 0, F.lit("error-data")).when(n <= 2, F.lit("retry-data")).otherwise(F.lit("weather-data"))


def _samples(spark, sf_dir):
    """Counter samples, one per event; the counters start again every 2000 messages."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("broker-"), (F.col("user_id") % 3).cast("string")).alias("instance"),
        F.when(F.col("event_id") % 89 == 0, F.lit("")).otherwise(_topic_name()).alias("topic"),
        (F.col("event_id") % 2000).alias("count"),
    )


@query("topic_tps")
def _topic_tps(spark, sf_dir):
    rates = topic_rates(_samples(spark, sf_dir), "1 hour")
    return rates.withColumn("rate", F.round("rate", 6))


@query("topic_rate_steps")
def _topic_rate_steps(spark, sf_dir):
    """The dashboard's rate each hour over the last six."""
    rates = rate_steps(_samples(spark, sf_dir), 3600, 6)
    return rates.withColumn("rate", F.round("rate", 9))


@query("topic_tps_counted")
def _topic_tps_counted(spark, sf_dir):
    records = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), _topic_name().alias("topic")
    )
    return topic_throughput(records, "1 hour").withColumn("rate", F.round("rate", 6))


@query("consumer_lag")
def _consumer_lag(spark, sf_dir):
    offsets = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("group"),
        _topic_name().alias("topic"),
        (F.col("user_id") % 10).alias("partition"),
        F.col("event_id").alias("end_offset"),
        F.when(F.col("user_id") % 50 > 0, F.col("event_id") - F.col("user_id") % 50).alias("committed"),
    )
    return consumer_lag(latest_offsets(offsets, "hour"))


@query("topic_list")
def _topic_list(spark, sf_dir):
    return topic_list(_samples(spark, sf_dir))


# --- streams ----------------------------------------------------------------------------------
def _run_once(rows: DataFrame, path: str, checkpoint: str) -> None:
    start_table(rows, path, checkpoint, trigger={"availableNow": True}).awaitTermination()


@query("stream_cooldown_alerts")
def _stream_cooldown_alerts(spark, sf_dir):
    """The whole table as a stream; must keep what the batch operator keeps."""
    source = work_dir(spark, "candidates")
    _candidates(spark, sf_dir).write.parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)
    out = work_dir(spark, "kept")
    _run_once(stream_cooldown(stream), out, work_dir(spark, "checkpoint"))
    return spark.read.parquet(out)


@query("stream_cooldown_seeded")
def _stream_cooldown_seeded(spark, sf_dir):
    """As ``cooldown_seeded``, the rest as a stream that starts from the stored alerts.

    The stream comes in four parts of some days, and keys give up their state between alerts.
    """
    found, source = work_dir(spark, "found"), work_dir(spark, "candidates")
    stored, out = work_dir(spark, "alerts"), work_dir(spark, "kept")
    checkpoint = work_dir(spark, "checkpoint")
    _candidates(spark, sf_dir).write.parquet(found)
    candidates = spark.read.parquet(found)
    borders = [F.lit(f"2024-01-{day}").cast("timestamp") for day in (11, 16, 21, 26)]
    time = F.col("event_time")
    cooldown(candidates.where(time < borders[0]), minutes=90).write.parquet(stored)
    seed = latest_alerts(spark.read.schema(candidates.schema).parquet(stored))
    for start, end in zip(borders, [*borders[1:], None]):
        part = (time >= start) if end is None else (time >= start) & (time < end)
        # As many files as there are tasks: all that is new when the stream goes on is a micro-batch.
        candidates.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(candidates.schema).parquet(source)
        kept = stream_cooldown(stream, minutes=90, seed=seed, delay="1 hour")
        _run_once(kept, out, checkpoint)
    return spark.read.parquet(out)


@query("stream_cooldown_batches")
def _stream_cooldown_batches(spark, sf_dir):
    """Two micro-batches through the batch operator, the second seeded by the first."""
    source, out = work_dir(spark, "candidates"), work_dir(spark, "kept")
    state, checkpoint = work_dir(spark, "state"), work_dir(spark, "checkpoint")
    candidates = _candidates(spark, sf_dir)
    border = F.lit("2024-01-16").cast("timestamp")
    for part in (F.col("event_time") < border, F.col("event_time") >= border):
        candidates.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(candidates.schema).parquet(source)
        start_cooldown(
            stream, out, state, checkpoint, trigger={"availableNow": True}
        ).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query("restart_exactly_once")
def _restart_exactly_once(spark, sf_dir):
    """Three runs of one stream with stops in between, the last without new input."""
    source, out = work_dir(spark, "candidates"), work_dir(spark, "kept")
    state, checkpoint = work_dir(spark, "state"), work_dir(spark, "checkpoint")
    candidates = _candidates(spark, sf_dir)
    border = F.lit("2024-01-16").cast("timestamp")
    for part in (F.col("event_time") < border, F.col("event_time") >= border, None):
        if part is not None:
            candidates.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(candidates.schema).parquet(source)
        start_cooldown(
            stream, out, state, checkpoint, trigger={"availableNow": True}
        ).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def _alerts_now(spark, topics, state, root) -> None:
    start_alerts(
        topics.stream(spark, TOPIC_READINGS), f"{root}/alerts", state, f"{root}/cp_alerts",
        rate=0.0, trigger={"availableNow": True},
    ).awaitTermination()


@query("replay_exactly_once")
def _replay_exactly_once(spark, sf_dir):
    """A producer is lost twice before its batch is whole, then writes it twice, with consumers
    running in between; archive and alerts hold every reading once."""
    root = work_dir(spark, "replay")
    topics, state = StoredTopics(f"{root}/topics"), AlertState(f"{root}/state")
    records = _reading_records(spark, sf_dir)
    topics.write(records.limit(0), TOPIC_READINGS, 0, "ingest")

    def lost(part: DataFrame) -> None:
        topics.stage(part, TOPIC_READINGS, 1, "ingest")

    def whole(part: DataFrame) -> None:
        topics.write(part, TOPIC_READINGS, 1, "ingest")

    for attempt in (lost, lost, whole, whole):
        attempt(records)
        readings = decode_readings(topics.stream(spark, TOPIC_READINGS))
        start_archive(
            readings, f"{root}/archive", f"{root}/cp_archive", trigger={"availableNow": True}
        ).awaitTermination()
        _alerts_now(spark, topics, state, root)
    archived = read_archive(spark, f"{root}/archive").groupBy("location").agg(
        F.count("*").alias("n_archived")
    )
    alerts = spark.read.parquet(f"{root}/alerts").groupBy("location").agg(
        F.count("*").alias("n_alerts"), F.countDistinct("alert_id").alias("n_ids"),
        F.count("raw_json").alias("n_raw"), F.count("created_at").alias("n_created"),
    )
    return archived.join(alerts, "location", "left")


@query("alerts_repeated_delivery")
def _alerts_repeated_delivery(spark, sf_dir):
    """Every reading comes twice in one micro-batch and again in the next."""
    root = work_dir(spark, "repeated")
    topics, state = StoredTopics(f"{root}/topics"), AlertState(f"{root}/state")
    records = _reading_records(spark, sf_dir)
    for n, part in enumerate((records.unionByName(records), records)):
        topics.write(part, TOPIC_READINGS, n, "ingest")
        _alerts_now(spark, topics, state, root)
    alerts = spark.read.parquet(f"{root}/alerts")
    return alerts.groupBy("alert_id", "location", "alert_type", "event_time", "threshold").agg(
        F.count("*").alias("n_rows"),
        F.min(F.get_json_object("raw_json", "$.Location")).alias("raw_location"),
        F.min(F.get_json_object("raw_json", "$.event_time")).alias("raw_time"),
    )


@query("stream_observed")
def _stream_observed(spark, sf_dir):
    """What ingest and alert streams observe in three micro-batches; the last brings one location's
    first days, all too late."""
    root = work_dir(spark, "observed")
    topics, state = StoredTopics(f"{root}/topics"), AlertState(f"{root}/state")
    regions, ingested = RegionTable(f"{root}/regions"), MetricLog(f"{root}/ingested")
    regions.start_with(region_map(spark))
    raw = raw_readings(spark, sf_dir)
    held_back, n = F.col("location") == "Busan", F.col("event_id")
    day = F.dayofmonth(event_time_lenient("date_time"))
    first = F.coalesce(day <= 10, n % 2 == 0)  # rows without a readable time go to either batch
    parts = (first & ~held_back, ~first, first & held_back)
    for part in parts:
        write_drops(raw.where(part), f"{root}/drops")
        start_ingest(
            stream_drops(spark, f"{root}/drops"), topics, regions, f"{root}/cp_ingest",
            metrics=ingested, trigger={"availableNow": True},
        ).awaitTermination()
        _alerts_now(spark, topics, state, root)
    counted = ingested.read(spark).groupBy("batch").pivot("metric", ["n_valid", "n_invalid"])
    untimed = spark.read.parquet(f"{root}/state/untimed").groupBy("batch").agg(
        F.count("*").alias("n_put_aside")
    )
    observed = state.progress(spark).drop("n_quarantined")
    both = counted.agg(F.first("value")).join(observed, "batch").join(untimed, "batch", "left")
    return both.fillna(0, ["n_put_aside"])


@query("consumer_lag_live")
def _consumer_lag_live(spark, sf_dir):
    """The backlog of a running stream after each batch of its topic, from its own reports.

    A micro-batch takes one file; the last one of a topic's batch leaves the backlog after it.
    """
    root = work_dir(spark, "lag")
    topics = StoredTopics(f"{root}/topics")
    valid = valid_readings(raw_readings(spark, sf_dir)).withColumn(
        "event_time", event_time_lenient("date_time")
    )
    day = F.dayofmonth(F.col("ts"))
    dated = valid.join(table(spark, sf_dir, "events").select("event_id", "ts"), "event_id")
    days = F.least(F.floor((day - 1) / 5), F.lit(5))
    sizes = dict(dated.groupBy(days).count().collect())
    for n in range(6):  # five days each, in files of a bounded size: a file limit is a batch limit
        files = -(-sizes.get(n, 1) // RECORDS_PER_FILE)
        part = dated.where(days == n).repartition(files, "event_id")
        topics.write(to_reading_records(part, region_map(spark)), TOPIC_READINGS, n, "ingest")
    log = ProgressLog(spark, f"{root}/progress", names=("lagging",))
    try:
        records = topics.stream(spark, TOPIC_READINGS, max_files=1)
        taken = records.observe("taken", F.count(F.lit(1)).alias("records"), F.max("batch").alias("batch"))
        start_table(
            taken, f"{root}/copy", f"{root}/checkpoint", name="lagging", trigger={"availableNow": True}
        ).awaitTermination()
    finally:
        log.close()
    total = topics.read(spark, TOPIC_READINGS).count()
    offsets = counted_offsets(log.read(), TOPIC_READINGS, total, "taken.records")
    lag = consumer_lag(offsets.withColumn("ts", F.col("batch"))).withColumnRenamed("ts", "batch")
    written = log.read().select("batch", F.col("metrics")["taken.batch"].alias("written"))
    after = lag.join(written, "batch").groupBy("written", "group").agg(F.min("lag").alias("lag"))
    return after.withColumnRenamed("written", "batch")


@query("late_alerts")
def _late_alerts(spark, sf_dir):
    """Alerts of two runs; the second brings one location's first days, all too late."""
    root = work_dir(spark, "late")
    topics, state = StoredTopics(f"{root}/topics"), AlertState(f"{root}/state")
    valid = valid_readings(raw_readings(spark, sf_dir)).withColumn(
        "event_time", event_time_lenient("date_time")
    )
    held_back, day = F.col("location") == "Busan", F.dayofmonth("event_time")
    parts = ((day <= 20) & ~held_back, (day > 20) | ((day <= 10) & held_back))
    for n, part in enumerate(parts):
        topics.write(to_reading_records(valid.where(part), region_map(spark)), TOPIC_READINGS, n, "ingest")
        start_alerts(
            topics.stream(spark, TOPIC_READINGS), f"{root}/alerts", state, f"{root}/checkpoint",
            rate=0.0, trigger={"availableNow": True},
        ).awaitTermination()
    late = state.progress(spark).agg(F.sum("n_late").alias("n_late")).scalar()
    alerts = spark.read.parquet(f"{root}/alerts")
    return alerts.select("alert_id", "location", "alert_type", "event_time", late.alias("n_late"))


@query("late_drop")
def _late_drop(spark, sf_dir):
    """Window counts over three runs; the third brings copies from the first, all too late."""
    source, out = work_dir(spark, "readings"), work_dir(spark, "counts")
    checkpoint = work_dir(spark, "checkpoint")
    timed = timed_readings(spark, sf_dir).select("event_id", "location", "event_time")
    day = F.dayofmonth("event_time")
    late = timed.where((day <= 10) & (F.col("event_id") % 7 == 0))
    parts = (
        timed.where(day <= 10),
        timed.where((day > 10) & (day <= 20)),
        timed.where(day > 20).unionByName(late),
    )
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(timed.schema).parquet(source)
        counts = window_counts_stream(stream, "1 hour")
        start_window_counts(
            counts, out, checkpoint, trigger={"availableNow": True}
        ).awaitTermination()
    return read_window_counts(spark, out)
