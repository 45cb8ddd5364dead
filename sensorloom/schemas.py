"""Spark schemas of the messages, tables and topic records."""

from pyspark.sql import types as T

from .constants import REQUIRED_FIELDS

RAW_COLUMNS = tuple(REQUIRED_FIELDS.values())

CORRUPT = "_corrupt_record"

# A reading message as the alert stream decodes it (retry is a double on the wire there).
READING_MESSAGE = T.StructType(
    [
        T.StructField("Location", T.StringType()),
        T.StructField("Date_Time", T.StringType()),
        T.StructField("Temperature_C", T.DoubleType()),
        T.StructField("Humidity_pct", T.DoubleType()),
        T.StructField("Precipitation_mm", T.DoubleType()),
        T.StructField("Wind_Speed_kmh", T.DoubleType()),
        T.StructField("retry", T.DoubleType()),
    ]
)

# A topic record, with the columns of Spark's Kafka source (key and value as text).
TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

ALERTS_TABLE = T.StructType(
    [
        T.StructField("alert_id", T.StringType(), False),
        T.StructField("location", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("alert_reason", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("slack_sent", T.BooleanType()),
        T.StructField("slack_sent_at", T.TimestampType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("raw_json", T.StringType()),
    ]
)

ERRORS_TABLE = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("raw_row", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("processing_status", T.StringType()),
        T.StructField("slack_sent", T.BooleanType()),
        T.StructField("slack_sent_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("detected_at", T.TimestampType()),
    ]
)
