"""The retry path: messages that either raise late alerts or end as dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CHAOS_REASON,
    COOLDOWN_MINUTES,
    REQUIRED_FIELDS,
    RETRY_DEFAULTS,
    RETRY_FAILED,
    RETRY_FAILED_FILE,
    TOPIC_ERRORS,
    TOPIC_READINGS,
    UNKNOWN_LOCATION,
)
from ..functions.once import once
from ..functions.parse import float_sql, iso_time, parse_float, retry_sql
from ..functions.sampling import sampled
from .cooldown import cooldown
from .routing import KEEP_NULLS, error_json, json_string
from .rules import RETRY_PROFILE, Profile, detect_candidates

FAIL_SALT = "retry-failure"


_FIELDS = (*REQUIRED_FIELDS, "retry", "event_time")
_MESSAGE = ", ".join(f"{name} string" for name in _FIELDS)
_DEFAULTED = ("Location", *RETRY_DEFAULTS, "retry", "event_time")


def decode_message(records: DataFrame, *keep: str) -> DataFrame:
    """Retry messages with any set of keys to columns.

    Absent numbers take their defaults, null and unreadable ones become null. ``location`` is
    ``unknown`` only where the key is absent. The message is parsed once as text fields; only
    where a field is null, its keys are listed too, to tell an absent key from a null.
    """
    value = F.col("value").cast("string")
    # a number that is not finite arrives as text in quotes
    texts = [f"btrim(`{name}`, '\"') as _{name}" for name in _FIELDS]
    parsed = records.select(*keep, "value", F.inline(F.array(F.from_json(value, _MESSAGE))))
    some_null = " or ".join(f"`{name}` is null" for name in _DEFAULTED)
    listed = parsed.selectExpr(
        *keep,
        "value",
        *texts,
        f"if({some_null}, named_struct('names', map_keys(from_json(string(value), 'map<string,string>'))), null)"
        " as _keys",
    )
    listed = listed.select(*keep, "value", *[f"_{name}" for name in _FIELDS], F.inline(F.array("_keys")))

    def absent(name: str) -> str:
        return f"(_{name} is null and not array_contains(names, '{name}'))"

    numbers = {
        REQUIRED_FIELDS[name]: F.expr(
            f"if({absent(name)}, double('{default}'), {float_sql('_' + name)})"
        )
        for name, default in RETRY_DEFAULTS.items()
    }
    return once(
        listed,
        location=F.expr(f"if({absent('Location')}, '{UNKNOWN_LOCATION}', _Location)"),
        **numbers,
        event_time=iso_time("_event_time"),
        _number=F.expr(f"if({absent('retry')}, 0, {retry_sql('_retry')})"),
    ).selectExpr(
        "*",
        "coalesce(_number, 0) + 1 as retry_count",
        f"_Location is null and {' and '.join(f'_{n} is null' for n in _DEFAULTED[1:])} and names is null"
        " as _broken",
        f"coalesce({absent('event_time')}, false) as _without_time",
        f"coalesce({absent('Temperature_C')}, false) as _without_temperature",
    )


def failure_reason(*identity: str, fail_rate: float = 0.0) -> Column:
    """Why a decoded message cannot be processed, null where it can.

    The sampled failure comes before the event time is looked at; a message without JSON or
    with a retry count that is no number comes before both.
    """
    return (
        F.when(F.expr("_broken"), F.lit("Invalid message"))
        .when(
            F.expr("_number is null"),
            F.expr("concat('Invalid retry count: ', coalesce(_retry, 'None'))"),
        )
        .when(sampled(fail_rate, FAIL_SALT, *identity), F.lit(CHAOS_REASON))
        .when(F.expr("_without_time"), F.lit("'event_time'"))
        .when(F.expr("_event_time is null"), F.lit("fromisoformat: argument must be str"))
        .when(
            F.expr("event_time is null"),
            F.expr("concat('Invalid isoformat string: ', chr(39), _event_time, chr(39))"),
        )
    )


def with_failure(decoded: DataFrame, *identity: str, fail_rate: float = 0.0) -> DataFrame:
    """Add the reason of failure; failures are simulated only where the caller names a rate."""
    return once(decoded, failure=failure_reason(*identity, fail_rate=fail_rate))


def retry_candidates(judged: DataFrame, *keep: str, profile: Profile = RETRY_PROFILE) -> DataFrame:
    """Alert candidates of the messages that did not fail."""
    sound = judged.where(F.col("failure").isNull())
    return detect_candidates(sound, profile, *keep, "location", "event_time", "retry_count")


def retry_alerts(
    judged: DataFrame,
    tie: str,
    *,
    minutes: float = COOLDOWN_MINUTES,
    seed: DataFrame | None = None,
    profile: Profile = RETRY_PROFILE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Candidates after the retry path's own cooldown; ``keep`` names columns they carry."""
    found = retry_candidates(judged, tie, *keep, profile=profile)
    return cooldown(found, tie=tie, minutes=minutes, seed=seed)


def retry_dead_letters(judged: DataFrame, *keep: str) -> DataFrame:
    """Failed messages as error records with the raised retry count, keyed by location.

    The message is carried over as it is; what is no JSON becomes a JSON text.
    """
    text = F.col("value").cast("string")
    raw = F.when(F.try_parse_json(text).isNotNull(), text).otherwise(json_string(text))
    return judged.where(F.col("failure").isNotNull()).select(
        *keep,
        "location",
        "retry_count",
        F.col("failure").alias("error_reason"),
        F.col("location").alias("key"),
        error_json(
            F.lit(RETRY_FAILED),
            F.col("failure"),
            raw,
            F.lit(RETRY_FAILED_FILE),
            F.col("retry_count"),
        ).alias("value"),
        F.lit(TOPIC_ERRORS).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
    )


def retry_republish(judged: DataFrame, max_retries: int, *keep: str) -> DataFrame:
    """Optional: sound messages below ``max_retries`` go back to the readings topic."""
    value = F.to_json(
        F.struct(
            F.col("_Location").alias("Location"),
            F.col("_Date_Time").alias("Date_Time"),
            F.col("temperature_c").alias("Temperature_C"),
            parse_float("_Humidity_pct").alias("Humidity_pct"),
            F.col("precipitation_mm").alias("Precipitation_mm"),
            F.col("wind_speed_kmh").alias("Wind_Speed_kmh"),
            F.col("retry_count").alias("retry"),
        ),
        KEEP_NULLS,
    )
    return judged.where(F.col("failure").isNull() & (F.col("retry_count") < max_retries)).select(
        *keep,
        "location",
        "retry_count",
        F.col("location").alias("key"),
        value.alias("value"),
        F.lit(TOPIC_READINGS).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
    )
