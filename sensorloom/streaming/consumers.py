"""Streams that read the topics: alerts with the diversion beside them, archive, retry, dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import (
    ARCHIVE_TRIGGER,
    COOLDOWN_MINUTES,
    REQUIRED_FIELDS,
    TOPIC_ERRORS,
    TOPIC_RETRY,
    WATERMARK,
    WINDOW,
)
from ..functions.once import once
from ..functions.parse import event_time_lenient, iso_text
from ..operators.alerts import alert_rows, carried_json, checked_alerts, store_alerts
from ..operators.archive import ARCHIVE_KEYS, archive_rows
from ..operators.cooldown import cooldown
from ..operators.deadletter import error_rows, record_id
from ..operators.retry import decode_message, retry_candidates, retry_dead_letters, with_failure
from ..operators.routing import decode_readings, is_diverted, reading_fields, to_retry_records
from ..operators.rules import ALERT_PROFILE, RETRY_PROFILE, Profile, detect_candidates
from ..operators.validate import ERROR_CONTRACT, check_contract
from ..operators.windows import without_time
from ..schemas import ALERTS_TABLE, ERRORS_TABLE
from ..session import read_or_empty
from ..sources.topics import position_of
from .observed import MetricLog

IDENTITY = tuple(REQUIRED_FIELDS.values())
# How far ahead of the clock a reading may be dated and still move event time on.
CLOCK_SKEW = "1 hour"


def decoded_readings(records: DataFrame) -> DataFrame:
    """Readings of records with their event time, null where it is unreadable, and a number that
    tells readings apart; a reading that is delivered twice has it twice."""
    decoded = once(decode_readings(records), event_time=event_time_lenient("date_time"))
    return decoded.withColumn("reading_id", F.xxhash64(*IDENTITY))


def window_counts_stream(
    readings: DataFrame, width: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """Rows per location and window; rows later than the watermark are dropped and counted
    by the stream's progress report. Start it with :func:`start_window_counts`."""
    return (
        readings.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", width), "location")
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "location",
            "n_rows",
        )
    )


def start_window_counts(
    counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write what changed in each micro-batch, windows that are still open too.

    ``read_window_counts`` gives the latest count of each window.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        counts.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def read_window_counts(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.parquet(path)
    return stored.groupBy("window_start", "window_end", "location").agg(
        F.max_by("n_rows", "batch").alias("n_rows")
    )


# --- alerts -----------------------------------------------------------------------------------
class AlertState:
    """What one alert job knows after each micro-batch, in folders addressed by its number: the last
    kept alert of every key, how far event time has come, and what was observed. Rows without an
    event time, which raise no alert, are kept there too."""

    last_schema = "location string, alert_type string, event_time timestamp"

    def __init__(self, path: str):
        self.path = path
        self.metrics = MetricLog(f"{path}/metrics")

    def last(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return read_or_empty(spark, f"{self.path}/last/batch={batch_id}", self.last_schema)

    def seen(self, spark: SparkSession, batch_id: int) -> int | None:
        """The latest event time up to a micro-batch in microseconds, None before the first."""
        rows = read_or_empty(spark, f"{self.metrics.path}/batch={batch_id}", MetricLog.schema)
        found = rows.where("metric = 'seen'").first()
        return found.value if found else None

    def progress(self, spark: SparkSession) -> DataFrame:
        """batch, n_rows, n_late, n_without_time, n_alerts and n_quarantined of every micro-batch."""
        names = ("n_rows", "n_late", "n_without_time", "n_alerts", "n_quarantined")
        found = self.metrics.read(spark).groupBy("batch").pivot("metric", list(names))
        return found.agg(F.first("value"))

    def untimed(self, batch_id: int) -> str:
        """Where the rows without an event time of a micro-batch are."""
        return f"{self.path}/untimed/batch={batch_id}"

    def save(self, spark: SparkSession, batch_id: int, written: DataFrame, **metrics: int) -> None:
        keys = ["location", "alert_type"]
        both = self.last(spark, batch_id - 1).unionByName(written.select(*keys, "event_time"))
        latest = both.groupBy(*keys).agg(F.max("event_time").alias("event_time"))
        latest.write.mode("overwrite").parquet(f"{self.path}/last/batch={batch_id}")
        self.metrics.save(spark, batch_id, **metrics)


def _keep_alerts(
    judged: DataFrame,
    candidates: Callable[[DataFrame], DataFrame],
    batch_id: int,
    *,
    path: str,
    state: AlertState,
    tie: str,
    minutes: float,
    profile: Profile,
    watermark: str,
    skew: str,
    quarantine: str | None,
) -> DataFrame:
    """Write the alerts of a micro-batch; returns its rows that are not late and have a time.

    A row is late if it lies further than ``watermark`` behind what was seen before this
    micro-batch; it raises nothing, and is counted. A time more than ``skew`` ahead of the clock
    does not count as seen, so one wrong reading does not make all later ones late. The counts are
    observed while the rows without a time are put aside, which reads every row once.
    """
    spark = judged.sparkSession
    seen = state.seen(spark, batch_id - 1)
    time = F.col("event_time")
    late = F.lit(False)
    if seen is not None:
        limit = F.timestamp_micros(F.lit(seen)) - F.expr(f"interval {watermark}")
        late = time < limit
    believable = time <= F.current_timestamp() + F.expr(f"interval {skew}")
    read = Observation(f"read-{batch_id}")
    observed = judged.observe(
        read,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(time.isNull()).alias("n_without_time"),
        F.count_if(F.coalesce(late, F.lit(False))).alias("n_late"),
        F.max(F.when(believable, F.unix_micros(time))).alias("seen"),
    )
    without_time(observed).write.mode("overwrite").parquet(state.untimed(batch_id))
    on_time = judged.where(time.isNotNull() & ~late)

    kept = cooldown(
        candidates(on_time), tie=tie, minutes=minutes, seed=state.last(spark, batch_id - 1)
    )
    rows = alert_rows(carried_json(kept), profile).persist(StorageLevel.MEMORY_AND_DISK)
    stored = Observation(f"stored-{batch_id}")
    folder = f"{path}/batch={batch_id}"
    try:
        fits, broken = checked_alerts(rows, strict=quarantine is None)
        fits = fits.observe(stored, F.count(F.lit(1)).alias("n"))
        store_alerts(fits, folder, mode="overwrite")
        n_broken = 0
        if quarantine is not None:
            aside = Observation(f"aside-{batch_id}")
            broken = broken.observe(aside, F.count(F.lit(1)).alias("n"))
            broken.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
            n_broken = aside.get["n"]
    finally:
        rows.unpersist()
    found = read.get
    latest = max((t for t in (seen, found["seen"]) if t is not None), default=None)
    counts = {name: found[name] for name in ("n_rows", "n_late", "n_without_time")}
    written = read_or_empty(spark, folder, ALERTS_TABLE)
    state.save(
        spark, batch_id, written, seen=latest, n_alerts=stored.get["n"], n_quarantined=n_broken,
        **counts,
    )
    return on_time


def start_alerts(
    records: DataFrame,
    path: str,
    state: AlertState,
    checkpoint: str,
    *,
    rate: float,
    topics=None,
    minutes: float = COOLDOWN_MINUTES,
    profile: Profile = ALERT_PROFILE,
    watermark: str = WATERMARK,
    skew: str = CLOCK_SKEW,
    quarantine: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Alerts of reading records, each reading looked at once, and the diversion beside them.

    A ``rate`` share of the readings goes to the retry topic of ``topics`` instead. A micro-batch
    is decoded once; the cooldown is the batch operator, which spreads a hot key over all tasks.
    A reading that is delivered more than once, in one micro-batch or in several, raises its alerts
    once. All outputs are addressed by the batch number: one that runs again replaces what it wrote.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        readings = decoded_readings(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            diverted = is_diverted(*IDENTITY, rate=rate)
            reading = reading_fields(iso_text("event_time").alias("event_time"))

            def candidates(on_time: DataFrame) -> DataFrame:
                checked = on_time.where(~diverted).withColumn("reading", reading)
                return detect_candidates(
                    checked, profile, "reading_id", "location", "event_time", "reading"
                )

            on_time = _keep_alerts(
                readings, candidates, batch_id, path=path, state=state, tie="reading_id",
                minutes=minutes, profile=profile, watermark=watermark, skew=skew,
                quarantine=quarantine,
            )
            if topics is not None:
                retries = to_retry_records(on_time.where(diverted))
                topics.write(retries, TOPIC_RETRY, batch_id, "alerting")
        finally:
            readings.unpersist()

    return _start_batches(records, work, checkpoint, trigger)


def judged_retries(records: DataFrame, fail_rate: float = 0.0) -> DataFrame:
    decoded = decode_message(records).withColumn("message_id", F.xxhash64("value"))
    return with_failure(decoded, "value", fail_rate=fail_rate)


def start_retries(
    records: DataFrame,
    path: str,
    state: AlertState,
    checkpoint: str,
    *,
    topics=None,
    fail_rate: float = 0.0,
    minutes: float = COOLDOWN_MINUTES,
    profile: Profile = RETRY_PROFILE,
    watermark: str = WATERMARK,
    skew: str = CLOCK_SKEW,
    quarantine: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Late alerts of retry records; messages that fail go to the error topic of ``topics``."""

    def candidates(on_time: DataFrame) -> DataFrame:
        message = on_time.withColumn("reading", F.col("value").cast("string"))
        return retry_candidates(message, "message_id", "reading", profile=profile)

    def work(batch: DataFrame, batch_id: int) -> None:
        judged = judged_retries(batch, fail_rate).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _keep_alerts(
                judged.where("failure is null"), candidates, batch_id, path=path, state=state,
                tie="message_id", minutes=minutes, profile=profile, watermark=watermark, skew=skew,
                quarantine=quarantine,
            )
            if topics is not None:
                topics.write(retry_dead_letters(judged), TOPIC_ERRORS, batch_id, "retry")
        finally:
            judged.unpersist()

    return _start_batches(records, work, checkpoint, trigger)


def _start_batches(
    records: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    return (
        records.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


# --- dead letters -----------------------------------------------------------------------------
def error_table_stream(records: DataFrame) -> DataFrame:
    """Rows of the error table with an id from the record's position."""
    position = position_of(records)
    rows = error_rows(records, *position, "timestamp")
    return rows.select(
        record_id(*position).alias("id"),
        *[c for c in rows.columns if c not in (*position, "timestamp")],
        F.col("timestamp").alias("created_at"),
    )


def start_errors(
    records: DataFrame, path: str, quarantine: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The error table of a topic, and apart from it the rows that break the table's contract;
    both are addressed by the batch number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fits, broken = check_contract(error_table_stream(batch), ERROR_CONTRACT)
        fits.select(*ERRORS_TABLE.fieldNames()).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )
        broken.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return _start_batches(records, write, checkpoint, trigger)


# --- sinks ------------------------------------------------------------------------------------
def start_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    date_of: str | None = None,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table; the sink's own log makes that exactly once."""
    writer = rows if date_of is None else rows.withColumn("date", F.to_date(date_of))
    stream = writer.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if date_of is not None:
        stream = stream.partitionBy("date")
    if name is not None:
        stream = stream.queryName(name)
    return stream.trigger(**(trigger or {"processingTime": "1 second"})).start(path)


def start_archive(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    *,
    rows_per_file: int | None = None,
    spread: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archive a stream of decoded readings.

    Rows of one folder come together in at most ``spread`` tasks, so that a hot location is
    not written by one task alone; without it, in as many as the session has shuffle partitions.
    """
    if spread is None:
        spread = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("date_time", "temperature_c"), F.lit(spread))
    rows = archive_rows(readings).repartition(*ARCHIVE_KEYS, share)
    writer = rows.writeStream.format("parquet").partitionBy(*ARCHIVE_KEYS)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": ARCHIVE_TRIGGER}))
        .start(path)
    )
