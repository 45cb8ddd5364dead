"""Readings as text, derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.once import once
from ..functions.parse import event_time_lenient
from ..operators.routing import to_retry_records
from ..operators.validate import valid_readings

# fixed values: the location of each user group
_GROUP_LOCATIONS = (
    "Phoenix",
    "Houston",
    "Los Angeles",
    "San Antonio",
    "San Diego",
    "Dallas",
    "Philadelphia",
    "San Jose",
    "Chicago",
    "New York",
    "Busan",
    "Jeju",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_raw_readings(events: DataFrame) -> DataFrame:
    """Text columns as a drop file has them, with blanks, bad numbers and bad dates mixed in."""
    names = ", ".join(f"'{name}'" for name in _GROUP_LOCATIONS)
    return events.selectExpr(
        "event_id",
        f"if(event_id % 211 = 0, '', get(array({names}), int(user_id % 12))) as location",
        "if(event_id % 97 = 0, '2024-99-99 99:99:99', date_format(ts, 'yyyy-MM-dd HH:mm:ss')) as date_time",
        """case when event_id % 53 = 0 then '' when event_id % 59 = 0 then 'abc_xyz'
           else string(cast(value as decimal(10,2)) - cast(10 as decimal(10,2))) end as temperature_c""",
        "if(event_id % 61 = 0, 'abc_xyz', string(20 + user_id % 70)) as humidity_pct",
        "get_json_object(props, '$.k') as precipitation_mm",
        "string(event_id % 45) as wind_speed_kmh",
        "date_format(ts, \"'weather_'yyyyMMdd'_000000.csv'\") as file_name",
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw_readings(table(spark, sf_dir, "events"))


def timed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid readings with a readable event time."""
    valid = valid_readings(raw_readings(spark, sf_dir))
    timed = once(valid, event_time=event_time_lenient("date_time"))
    return timed.where(F.col("event_time").isNotNull())


def retry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry records of all timed readings, some with absent keys, nulls or bad values."""
    records = to_retry_records(timed_readings(spark, sf_dir), "event_id")
    value, event_id = F.col("value"), F.col("event_id")
    temperature = r'"Temperature_C":[^,]*,'
    changed = (
        F.when(event_id % 101 == 0, F.regexp_replace(value, r',"event_time":"[^"]*"', ""))
        .when(event_id % 103 == 0, F.regexp_replace(value, r'"retry":0', '"retry":"x"'))
        .when(event_id % 107 == 0, F.regexp_replace(value, temperature, ""))
        .when(event_id % 109 == 0, F.regexp_replace(value, temperature, '"Temperature_C":null,'))
        .when(event_id % 113 == 0, F.regexp_replace(value, r'"retry":0', '"retry":2.0'))
        .when(event_id % 127 == 0, F.regexp_replace(value, r'T\d\d:', "T99:"))
        .otherwise(value)
    )
    return records.withColumn("value", changed)
