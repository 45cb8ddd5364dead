"""Error envelopes to rows of the error table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import STATUS_NEW
from ..functions.once import once

_ENVELOPE = (
    "error_type string, error_reason string, raw_row string, timestamp double, "
    "file_name string, retry_count int"
)


def error_rows(records: DataFrame, *keep: str) -> DataFrame:
    """Project error records to the error table.

    The raw row stays JSON text, its location becomes a column, a missing retry count is 0 and
    the state is new and unsent. ``detected_at`` is the time noted in the envelope, if any.
    """
    envelope = F.from_json(F.col("value").cast("string"), _ENVELOPE)
    parsed = once(records.select(*keep, "value"), e=envelope)
    raw = F.col("e.raw_row")
    return parsed.select(
        *keep,
        F.col("e.error_type").alias("error_type"),
        F.col("e.error_reason").alias("error_message"),
        raw.alias("raw_row"),
        F.get_json_object(raw, "$.Location").alias("location"),
        F.col("e.file_name").alias("file_name"),
        F.coalesce("e.retry_count", F.lit(0)).alias("retry_count"),
        F.lit(STATUS_NEW).alias("processing_status"),
        F.lit(False).alias("slack_sent"),
        F.lit(None).cast("timestamp").alias("slack_sent_at"),
        F.timestamp_micros((F.col("e.timestamp") * 1_000_000).cast("bigint")).alias("detected_at"),
    )


def record_id(*position: str):
    """The id of a record's row: MD5 of its position, so that a replay gives the same id."""
    return F.md5(F.concat_ws("|", *position))
