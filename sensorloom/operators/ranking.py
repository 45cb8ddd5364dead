"""Row numbers over a whole table without one task seeing the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, order: Sequence[str], coarse: str, output: str) -> DataFrame:
    """Number rows from 0 in ``order``, whose first part must be the timestamp ``coarse``.

    Rows are numbered per second of ``coarse``, and the counts of earlier seconds are added.
    The running count goes over one row per second, first within days and then over days, so
    no window holds more than a day of seconds or the days of the whole table.
    """
    by_second = df.withColumn("_second", F.date_trunc("second", coarse)).withColumn(
        "_number", F.row_number().over(Window.partitionBy("_second").orderBy(*order)).cast("bigint")
    )
    seconds = by_second.groupBy("_second").agg(F.count("*").alias("_rows"))
    seconds = seconds.withColumn("_day", F.to_date("_second"))
    days = seconds.groupBy("_day").agg(F.sum("_rows").alias("_rows"))

    before_day = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before_second = (
        Window.partitionBy("_day").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    )
    nothing = F.lit(0).cast("bigint")
    day_start = days.select(
        "_day", F.coalesce(F.sum("_rows").over(before_day), nothing).alias("_day_start")
    )
    second_start = seconds.select(
        "_second",
        "_day",
        F.coalesce(F.sum("_rows").over(before_second), nothing).alias("_second_start"),
    ).join(day_start, "_day")
    return (
        by_second.join(second_start.drop("_day"), "_second")
        .withColumn(output, F.col("_day_start") + F.col("_second_start") + F.col("_number") - 1)
        .drop("_second", "_number", "_day_start", "_second_start")
    )
