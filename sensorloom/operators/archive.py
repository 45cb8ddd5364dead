"""The archive of valid readings: Parquet by location and date, and its daily summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.once import once
from ..functions.parse import event_time_strict, or_unknown
from ..session import empty_frame, read_or_empty
from ..sources.publish import publish

ARCHIVE_KEYS = ("location", "date")


def archive_rows(readings: DataFrame) -> DataFrame:
    """Rows whose time has the strict format, with event time and date; others are skipped."""
    return (
        once(readings, event_time=event_time_strict("date_time"))
        .where(F.col("event_time").isNotNull())
        .withColumn("location", or_unknown("location"))
        .withColumn("date", F.to_date("event_time"))
    )


def write_archive(
    rows: DataFrame,
    path: str,
    rows_per_file: int | None = None,
    mode: str = "append",
) -> None:
    """Write under ``location=/date=`` folders, with at most ``rows_per_file`` rows per file if
    that is given.

    The rebalance brings rows of one folder together so that few files are written, and splits
    a folder that holds too much for one task: files are sized by bytes.
    """
    writer = rows.hint("rebalance", *ARCHIVE_KEYS).write.mode(mode).partitionBy(*ARCHIVE_KEYS)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def read_archive(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The archive, with the folder columns typed as text and date."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.parquet(path)
    return frame.withColumn("location", F.col("location").cast("string")).withColumn(
        "date", F.col("date").cast("date")
    )


def archive_layout(rows: DataFrame, rows_per_file: int) -> DataFrame:
    """What the archive holds per folder: rows, and the fewest files they need."""
    return (
        rows.groupBy(*ARCHIVE_KEYS)
        .agg(
            F.count("*").alias("n_rows"),
            F.min("event_time").alias("first_time"),
            F.max("event_time").alias("last_time"),
        )
        .withColumn("min_files", F.ceil(F.col("n_rows") / rows_per_file))
    )


def _finite(column: str) -> Column:
    value = F.col(column)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def _exact(column: str) -> Column:
    """The value as a decimal, null where the decimal is another number than the double."""
    decimal = F.col(column).try_cast("decimal(38,12)")
    return F.when(decimal.cast("double") == F.col(column), decimal)


# Columns whose sums a summary needs; a summary's parts keep them so that they can be merged.
_SUMMED = ("temperature_c", "precipitation_mm")


def daily_parts(rows: DataFrame) -> DataFrame:
    """What each location and date of ``rows`` adds to a summary, to be merged with other parts.

    A sum is kept twice: over decimals where they say the numbers exactly, with the number of
    those, so that it does not depend on the order of rows or parts; and over doubles.
    """
    sums = [
        made
        for c in _SUMMED
        for made in (
            F.try_sum(_exact(c)).alias(f"{c}_exact"),
            F.count(_exact(c)).alias(f"{c}_n_exact"),
            F.sum(_finite(c)).alias(f"{c}_sum"),
            F.count(_finite(c)).alias(f"{c}_n"),
        )
    ]
    return rows.groupBy(*ARCHIVE_KEYS).agg(
        F.count("*").alias("n_readings"),
        F.min("temperature_c").alias("min_temperature"),
        F.max("temperature_c").alias("max_temperature"),
        F.max("wind_speed_kmh").alias("max_wind_speed"),
        *sums,
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of one location and date as one part; merging them in any grouping gives the same."""
    sums = []
    for c in _SUMMED:
        # A part that has exact numbers but no exact sum ran out of digits: so does the whole.
        lost = F.bool_or((F.col(f"{c}_n_exact") > 0) & F.col(f"{c}_exact").isNull())
        sums += [
            F.when(~lost, F.try_sum(f"{c}_exact")).cast("decimal(38,12)").alias(f"{c}_exact"),
            F.sum(f"{c}_n_exact").alias(f"{c}_n_exact"),
            F.sum(f"{c}_sum").alias(f"{c}_sum"),
            F.sum(f"{c}_n").alias(f"{c}_n"),
        ]
    return parts.groupBy(*ARCHIVE_KEYS).agg(
        F.sum("n_readings").alias("n_readings"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.max("max_wind_speed").alias("max_wind_speed"),
        *sums,
    )


def _total(column: str) -> Column:
    """The sum of all finite numbers of a part: the exact one if it covers all of them."""
    exact = F.col(f"{column}_exact").cast("double")
    whole = F.col(f"{column}_n_exact") == F.col(f"{column}_n")
    return F.when(whole & exact.isNotNull(), exact).otherwise(F.col(f"{column}_sum"))


def summary_of(parts: DataFrame) -> DataFrame:
    """The summary that merged parts stand for."""
    return parts.select(
        *ARCHIVE_KEYS,
        "n_readings",
        "min_temperature",
        "max_temperature",
        F.try_divide(_total("temperature_c"), F.col("temperature_c_n")).alias("avg_temperature"),
        _total("precipitation_mm").alias("total_precipitation"),
        "max_wind_speed",
    )


def daily_summary(rows: DataFrame) -> DataFrame:
    """Per location and date: count, temperature and wind range, rain total.

    Averages and sums are over all finite numbers.
    """
    return summary_of(daily_parts(rows))


class DailySummaries:
    """The daily summary of a growing archive, from stored parts; the archive is not read again.

    Every batch adds its parts under ``parts/batch=<n>``, and one that runs again replaces them.
    Reading merges the parts. ``roll_up`` merges those up to a batch into one table, published in
    one step, so that what is read stays as small as the days are many.
    """

    def __init__(self, path: str):
        self.path = path

    def rolled(self, spark: SparkSession) -> int:
        """The batch up to which parts are merged; -1 before the first roll-up."""
        done = read_or_empty(spark, f"{self.path}/rolled", f"{_parts_ddl(spark)}, upto long")
        last = done.agg(F.max("upto")).first()[0]
        return -1 if last is None else last

    def add(self, rows: DataFrame, batch_id: int) -> None:
        if batch_id > self.rolled(rows.sparkSession):  # else it runs again, and is in already
            daily_parts(rows).write.mode("overwrite").parquet(f"{self.path}/parts/batch={batch_id}")

    def _parts(self, spark: SparkSession) -> DataFrame:
        last, ddl = self.rolled(spark), _parts_ddl(spark)
        done = read_or_empty(spark, f"{self.path}/rolled", f"{ddl}, upto long")
        new = read_or_empty(spark, f"{self.path}/parts", f"{ddl}, batch long")
        done = done.where(F.col("upto") == last).drop("upto")
        return done.unionByName(new.where(F.col("batch") > last).drop("batch"))

    def read(self, spark: SparkSession) -> DataFrame:
        return summary_of(merge_parts(self._parts(spark)))

    def roll_up(self, spark: SparkSession, upto: int) -> None:
        """Merge the parts of all batches up to one; batches up to it must have been added."""
        last, ddl = self.rolled(spark), _parts_ddl(spark)
        if upto <= last:
            return
        done = read_or_empty(spark, f"{self.path}/rolled", f"{ddl}, upto long")
        new = read_or_empty(spark, f"{self.path}/parts", f"{ddl}, batch long")
        new = new.where((F.col("batch") > last) & (F.col("batch") <= upto)).drop("batch")
        both = done.where(F.col("upto") == last).drop("upto").unionByName(new)
        staged = f"{self.path}/_staged/upto={upto}"
        merge_parts(both).write.mode("overwrite").parquet(staged)
        publish(spark, staged, f"{self.path}/rolled/upto={upto}")


def _parts_ddl(spark: SparkSession) -> str:
    readings = "location string, date date, temperature_c double, precipitation_mm double, wind_speed_kmh double"
    fields = daily_parts(empty_frame(spark, readings)).schema.fields
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)


def refresh_daily_summary(archive: DataFrame, days: DataFrame, path: str) -> None:
    """Write the summaries of the given ``days`` (column ``date``), and of no other day.

    They are made from the whole ``archive``, whose folders of other days are not read, so new
    readings of a part of a day, or of some locations, leave the rest of the day in place.
    """
    touched = days.select("date").where("date is not null").distinct()
    (
        daily_summary(archive.join(touched, "date", "left_semi"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
