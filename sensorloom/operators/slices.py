"""Time slices: the rows of each interval as one named unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SLICE_SECONDS


def time_span(readings: DataFrame, time: str = "event_time") -> DataFrame:
    """First and last time, both cut to the minute, and the number of rows with a time."""
    return readings.agg(
        F.date_trunc("minute", F.min(time)).alias("start_time"),
        F.date_trunc("minute", F.max(time)).alias("end_time"),
        F.count(time).alias("n_rows"),
    )


def with_slice(
    readings: DataFrame,
    seconds: int = SLICE_SECONDS,
    time: str = "event_time",
    origin: Column | None = None,
) -> DataFrame:
    """Add ``slice_start`` and ``slice_name``; slices follow each other from the first minute.

    Slices without rows do not appear. Rows without a time are in no slice. Without an ``origin``
    the readings are looked through twice, the first time for their first minute.
    """
    start = origin
    if start is None:
        start = readings.select(F.date_trunc("minute", F.min(time)).alias("s")).scalar()
    origin = F.unix_seconds(start)
    offset = F.unix_seconds(time) - origin
    begin = F.timestamp_seconds(origin + offset - F.pmod(offset, F.lit(seconds)))
    return (
        readings.where(F.col(time).isNotNull())
        .withColumn("slice_start", begin)
        .withColumn("slice_name", F.date_format("slice_start", "'weather_'yyyyMMdd_HHmmss"))
    )


def in_range(readings: DataFrame, start, end, time: str = "event_time") -> DataFrame:
    """Rows with ``start <= time < end``; a plain range that reaches the Parquet scan."""
    return readings.where((F.col(time) >= start) & (F.col(time) < end))


def write_slices(
    sliced: DataFrame, path: str, rows_per_file: int = 0, time: str = "event_time"
) -> None:
    """One folder of CSV files with a header per slice, the rows of each file in time order."""
    writer = (
        sliced.drop("slice_start")
        .hint("rebalance", "slice_name")
        .sortWithinPartitions("slice_name", time)
        .write.mode("append")
        .option("header", True)
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy("slice_name").csv(path)
