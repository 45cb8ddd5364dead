"""Which topic and which partition a row goes to."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    REGION_PARTITIONS,
    REQUIRED_FIELDS,
    TOPIC_ERRORS,
    TOPIC_PARTITIONS,
    TOPIC_READINGS,
    TOPIC_RETRY,
)
from ..functions.parse import iso_text, or_unknown
from ..functions.sampling import sampled
from ..schemas import READING_MESSAGE
from ..session import empty_frame
from .ranking import number_rows

KEEP_NULLS = {"ignoreNullFields": "false"}
DIVERT_SALT = "divert"


# --- location -> partition --------------------------------------------------------------------
def region_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The location dimension (location, partition).

    From a JSON object file; a missing or broken file is an empty dimension, as on first start.
    """
    if path is None:
        # literal rows: their size is known, so the join can be planned as a broadcast
        rows = ", ".join(f"('{name}', {number})" for name, number in REGION_PARTITIONS.items())
        return spark.sql(f"select * from values {rows} as regions(location, partition)")
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, "location string, partition int")
    pairs = F.from_json("value", "map<string,int>")
    return whole.select(F.explode(pairs).alias("location", "partition"))


def assign_partition(readings: DataFrame, regions: DataFrame) -> DataFrame:
    """Add ``partition``, null for locations the dimension does not know.

    No broadcast hint: Spark broadcasts the dimension while its measured size is below the
    threshold, and beyond it splits hot locations of the sort-merge join.
    """
    known = regions.select(F.col("location"), F.col("partition"))
    return readings.join(known, "location", "left")


def allocate_new(
    readings: DataFrame,
    regions: DataFrame,
    partitions: int = TOPIC_PARTITIONS,
    first_seen: str = "event_time",
) -> DataFrame:
    """New dimension rows for locations seen for the first time, in first-seen order.

    The n-th location ever gets partition ``n % partitions``. Works on one row per location.
    """
    never = F.lit("9999-12-31").cast("timestamp")  # locations without any readable time go last
    seen = readings.groupBy("location").agg(
        F.coalesce(F.min(first_seen), never).alias("first_seen")
    )
    fresh = seen.join(regions.select("location"), "location", "left_anti")
    known = regions.agg(F.count("*").alias("n")).scalar()
    numbered = number_rows(fresh, ["first_seen", "location"], "first_seen", "_n")
    return numbered.select(
        "location",
        F.pmod(known + F.col("_n"), F.lit(partitions)).cast("int").alias("partition"),
    )


# --- sampled diversion ------------------------------------------------------------------------
def is_diverted(*identity: str, rate: float) -> Column:
    """Whether a reading goes to the retry topic instead of being checked for alerts."""
    return sampled(rate, DIVERT_SALT, *identity)


# --- messages ---------------------------------------------------------------------------------
def reading_fields(*extra: Column) -> Column:
    """A reading under its wire names."""
    fields = [F.col(column).alias(name) for name, column in REQUIRED_FIELDS.items()]
    return F.struct(*fields, F.col("retry").alias("retry"), *extra)


def reading_json(*extra: Column) -> Column:
    """A reading as a JSON message under its wire names; null fields are kept."""
    return F.to_json(reading_fields(*extra), KEEP_NULLS)


def error_json(
    error_type: Column,
    error_reason: Column,
    raw_json: Column,
    file_name: Column,
    retry_count: Column,
    timestamp: Column | None = None,
) -> Column:
    """The error envelope; ``timestamp`` is optional.

    ``raw_json`` is JSON text and goes in unchanged: it is put between the two halves of the
    envelope, so numbers keep their spelling and nothing is parsed again.
    """
    head = F.to_json(
        F.struct(error_type.alias("error_type"), error_reason.alias("error_reason")), KEEP_NULLS
    )
    rest = [file_name.alias("file_name"), retry_count.alias("retry_count")]
    if timestamp is not None:
        rest.insert(0, timestamp.alias("timestamp"))
    tail = F.to_json(F.struct(*rest), KEEP_NULLS)
    return F.concat(
        F.substr(head, F.lit(1), F.length(head) - 1),
        F.lit(',"raw_row":'),
        F.coalesce(raw_json, F.lit("null")),
        F.lit(","),
        F.substr(tail, F.lit(2)),
    )


def json_string(text: Column) -> Column:
    """Any text as a quoted JSON string."""
    wrapped = F.to_json(F.struct(text.alias("v")), KEEP_NULLS)
    return F.substr(wrapped, F.lit(len('{"v":') + 1), F.length(wrapped) - len('{"v":}'))


def to_reading_records(valid: DataFrame, regions: DataFrame, *keep: str) -> DataFrame:
    """Valid readings as topic records, keyed by location and sent to its partition."""
    placed = assign_partition(valid, regions)
    return placed.select(
        *keep,
        or_unknown("location").alias("key"),
        reading_json().alias("value"),
        F.lit(TOPIC_READINGS).alias("topic"),
        "partition",
    )


def to_error_records(rejected: DataFrame, timestamp: Column | None = None, *keep: str) -> DataFrame:
    """Rejected rows as error envelopes; without a partition, so the key decides."""
    now = F.unix_micros(F.current_timestamp()) / 1e6 if timestamp is None else timestamp
    return rejected.select(
        *keep,
        or_unknown("location").alias("key"),
        error_json(
            F.col("error_type"),
            F.col("error_reason"),
            reading_json(),
            F.col("file_name"),
            F.lit(0),
            now,
        ).alias("value"),
        F.lit(TOPIC_ERRORS).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
    )


def to_retry_records(diverted: DataFrame, *keep: str) -> DataFrame:
    """Diverted readings as retry messages: the reading plus its event time as ISO text."""
    return diverted.select(
        *keep,
        F.col("location").alias("key"),
        reading_json(iso_text("event_time").alias("event_time")).alias("value"),
        F.lit(TOPIC_RETRY).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
    )


def decode_readings(records: DataFrame, *keep: str) -> DataFrame:
    """Topic records to readings with the fixed schema.

    A malformed message gives a row of nulls, a bad field a null in that field.
    """
    message = F.from_json(F.col("value").cast("string"), READING_MESSAGE, {"mode": "PERMISSIVE"})
    # one parse per row, whatever filters follow (see functions.once)
    data = records.select(*keep, F.inline(F.array(message)))
    columns = [F.col(name).alias(column) for name, column in REQUIRED_FIELDS.items()]
    return data.select(*keep, *columns, "retry")
