"""The alerts table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import iso_text
from ..schemas import ALERTS_TABLE
from .routing import KEEP_NULLS
from .rules import Profile, describe_alerts
from .validate import ALERT_CONTRACT, check_contract, violation

ALERT_KEYS = ("location", "alert_type")


def alert_id(profile: str) -> Column:
    """An id that a replay computes again: MD5 of profile, location, type and event time.

    Within a profile the cooldown keeps one alert per location, type and instant.
    """
    return F.md5(
        F.concat_ws("|", F.lit(profile), "location", "alert_type", iso_text("event_time"))
    )


def alert_rows(kept: DataFrame, profile: Profile, *keep: str) -> DataFrame:
    """Kept alerts as rows of the alerts table, not sent yet.

    ``retry_count`` and ``raw_json`` are taken from the input where it has them (``carried_json``);
    ``created_at`` is left to the writer.
    """
    described = describe_alerts(kept, profile)
    retry_count = F.col("retry_count") if "retry_count" in kept.columns else F.lit(0)
    raw_json = F.col("raw_json") if "raw_json" in kept.columns else F.lit(None).cast("string")
    return described.select(
        *keep,
        alert_id(profile.name).alias("alert_id"),
        "location",
        "alert_type",
        "alert_reason",
        "event_time",
        "value",
        "threshold",
        F.lit(False).alias("slack_sent"),
        F.lit(None).cast("timestamp").alias("slack_sent_at"),
        retry_count.cast("int").alias("retry_count"),
        raw_json.alias("raw_json"),
    )


def distinct_alerts(alerts: DataFrame) -> DataFrame:
    """One row per alert id, for tables into which a batch was written twice."""
    return alerts.dropDuplicates(["alert_id"])


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type").agg(F.count("*").alias("n_alerts"))


def find_alerts(
    alerts: DataFrame,
    *,
    since=None,
    until=None,
    locations: list[str] | None = None,
    alert_types: list[str] | None = None,
    sent: bool | None = None,
) -> DataFrame:
    """Alerts by time range, location, type and sent state; all reach the Parquet scan.

    A table that is foldered by date is only read in the folders of the time range.
    """
    found = alerts
    foldered = "date" in alerts.columns
    if since is not None:
        found = found.where(F.col("event_time") >= since)
        if foldered:
            found = found.where(F.col("date") >= F.to_date(since))
    if until is not None:
        found = found.where(F.col("event_time") < until)
        if foldered:
            found = found.where(F.col("date") <= F.to_date(until))
    if locations is not None:
        found = found.where(F.col("location").isin(locations))
    if alert_types is not None:
        found = found.where(F.col("alert_type").isin(alert_types))
    if sent is not None:
        found = found.where(F.col("slack_sent") == sent)
    return found


def carried_json(alerts: DataFrame, carried: str = "reading") -> DataFrame:
    """Turn the reading that each alert carries into its ``raw_json``.

    Candidates carry their reading as one column (``routing.reading_fields``, or the text of a
    message), so the aggregation that finds the first alert of an instant takes the reading along:
    nothing is joined back, and a reading that was delivered twice is one alert.
    """
    is_text = alerts.schema[carried].dataType == T.StringType()
    raw = F.col(carried) if is_text else F.to_json(carried, KEEP_NULLS)
    return alerts.withColumn("raw_json", raw).drop(carried)


def checked_alerts(
    alerts: DataFrame, created_at: Column | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Alerts in the columns of their table, and those that break its contract (with why); with
    ``strict`` one that breaks it is an error."""
    made = F.current_timestamp() if created_at is None else created_at
    if strict:
        reason = F.concat(F.lit("an alert breaks its table's contract: "), violation(ALERT_CONTRACT))
        broken = violation(ALERT_CONTRACT).isNotNull()
        alerts = alerts.where(F.when(broken, F.raise_error(reason)).otherwise(True))
    fits, broken = check_contract(alerts.withColumn("created_at", made), ALERT_CONTRACT)
    return fits.select(*[c for c in ALERTS_TABLE.fieldNames()]), broken


def write_alerts(
    alerts: DataFrame, path: str, quarantine: str | None = None, mode: str = "append"
) -> None:
    """Write to an alerts table that is foldered by date.

    Rows that break the table's contract go to ``quarantine``; without one they are an error.
    """
    fits, broken = checked_alerts(alerts, strict=quarantine is None)
    if quarantine is not None:
        broken.write.mode(mode).parquet(quarantine)
    store_alerts(fits, path, mode)


def store_alerts(
    fits: DataFrame, path: str, mode: str = "append", row_group_bytes: int | None = None
) -> None:
    """Write rows of the alerts table for lookups by time, location and type.

    A date is a folder. Within it rows lie by location, type and time, so the statistics of a
    row group span few locations and a lookup skips the others; what statistics cannot tell (ids,
    and types within one location) is left to bloom filters.
    """
    writer = (
        fits.withColumn("date", F.to_date("event_time"))
        .hint("rebalance", "date")
        .sortWithinPartitions("date", "location", "alert_type", "event_time")
        .write.mode(mode)
        .partitionBy("date")
    )
    for column in ("alert_id", "location", "alert_type"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
