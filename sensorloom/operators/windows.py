"""Tumbling windows over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import WINDOW


def with_window(readings: DataFrame, width: str = WINDOW, time: str = "event_time") -> DataFrame:
    """Add the window's start and end to every row: a projection, nothing is shuffled.

    This is the row form of collecting a window; whoever only walks the rows of a window
    needs no more. Rows without an event time belong to no window and are dropped.
    """
    return (
        readings.where(F.col(time).isNotNull())
        .withColumn("_window", F.window(time, width))
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def without_time(readings: DataFrame, time: str = "event_time") -> DataFrame:
    """The rows that windows would drop, for a quarantine."""
    return readings.where(F.col(time).isNull())


def window_counts(readings: DataFrame, width: str = WINDOW, *by: str) -> DataFrame:
    """Rows per window (and other columns), combined on the map side."""
    return (
        readings.groupBy(F.window("event_time", width), *by)
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *by,
            "n_rows",
        )
    )


def collect_windows(
    readings: DataFrame,
    width: str = WINDOW,
    by: str = "location",
    rows_per_array: int = 100_000,
    part_by: str = "event_id",
) -> DataFrame:
    """Rows of each window and location as an array.

    A window of a location with more than about ``rows_per_array`` rows, which would be too much
    for one task, comes in as many arrays (``part`` 0, 1, ...) as its measured size asks for. All
    rows are kept.
    """
    rows = F.struct(*[F.col(c) for c in readings.columns])
    timed = readings.where(F.col("event_time").isNotNull()).select(
        F.window("event_time", width).alias("window"), F.col(by), rows.alias("_row")
    )
    sizes = timed.groupBy("window", by).agg(
        F.ceil(F.count("*") / rows_per_array).alias("_parts")
    )
    large = sizes.where(F.col("_parts") > 1).withColumnRenamed(by, "_by")
    same = F.col("rows.window").eqNullSafe(F.col("large.window")) & F.col(f"rows.{by}").eqNullSafe(
        F.col("large._by")
    )
    placed = timed.alias("rows").join(large.alias("large"), same, "left")
    part = F.pmod(F.xxhash64(F.col(f"rows._row.{part_by}")), F.coalesce("large._parts", F.lit(1)))
    return (
        placed.select("rows.window", f"rows.{by}", part.cast("int").alias("part"), "rows._row")
        .groupBy("window", by, "part")
        .agg(F.collect_list("_row").alias("rows"))
    )
