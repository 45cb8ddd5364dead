"""Threshold rules: a profile of declarative rules, compiled to column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import DataFrame

from ..constants import ALERT_THRESHOLDS, RETRY_THRESHOLDS
from ..functions.parse import float_text_sql


@dataclass(frozen=True)
class Rule:
    alert_type: str
    column: str
    op: str  # ">=" or "<="
    threshold: float
    label: str
    unit: str

    def fires(self) -> str:
        """Condition in SQL. Boundary inclusive; null and NaN never fire."""
        c = f"`{self.column}`"
        return f"coalesce({c} {self.op} double('{self.threshold}') and not isnan({c}), false)"

    def reason(self, value: str) -> str:
        """Reason text in SQL."""
        limit = f"{self.unit} {self.op} {self.threshold}{self.unit}"
        return f"concat('{self.label} ', {float_text_sql(value)}, '{limit}')"


@dataclass(frozen=True)
class Profile:
    """A named set of rules. ``all_or_nothing``: a row with any null input raises no alert."""

    name: str
    rules: tuple[Rule, ...]
    all_or_nothing: bool = False

    def inputs(self) -> list[str]:
        return list(dict.fromkeys(rule.column for rule in self.rules))

    def any_fires(self) -> str:
        hit = "(" + " or ".join(rule.fires() for rule in self.rules) + ")"
        if self.all_or_nothing:
            hit += "".join(f" and `{c}` is not null" for c in self.inputs())
        return hit


def weather_rules(thresholds: dict[str, float]) -> tuple[Rule, ...]:
    # fixed values: alert types, compared columns and reason texts
    return (
        Rule("TEMP_HIGH", "temperature_c", ">=", thresholds["TEMP_HIGH"], "Temperature", "°C"),
        Rule("TEMP_LOW", "temperature_c", "<=", thresholds["TEMP_LOW"], "Temperature", "°C"),
        Rule("RAIN_HEAVY", "precipitation_mm", ">=", thresholds["RAIN_HEAVY"], "Rainfall", "mm"),
        Rule("WIND_STRONG", "wind_speed_kmh", ">=", thresholds["WIND_STRONG"], "Wind", " km/h"),
    )


ALERT_PROFILE = Profile("alert", weather_rules(ALERT_THRESHOLDS))
RETRY_PROFILE = Profile("retry", weather_rules(RETRY_THRESHOLDS), all_or_nothing=True)


def detect_candidates(readings: DataFrame, profile: Profile, *keep: str) -> DataFrame:
    """One row per fired rule: the kept columns, ``alert_type`` and ``value``.

    Narrow on purpose (only what the cooldown has to shuffle): threshold and reason follow
    from type and value, see :func:`describe_alerts`.
    """
    fired = ", ".join(
        f"if({rule.fires()}, named_struct('alert_type', '{rule.alert_type}', 'value', `{rule.column}`), null)"
        for rule in profile.rules
    )
    one_row_per_rule = readings.where(profile.any_fires()).selectExpr(
        *keep, f"inline(array({fired}))"
    )
    return one_row_per_rule.where("alert_type is not null")


def detect_either(
    readings: DataFrame, flag: str, then: Profile, otherwise: Profile, *keep: str
) -> DataFrame:
    """``detect_candidates`` by one profile where ``flag`` is true and by another elsewhere, in one
    look at each reading."""
    fired = ", ".join(
        f"if({side} and {rule.fires()}, "
        f"named_struct('alert_type', '{rule.alert_type}', 'value', `{rule.column}`), null)"
        for profile, side in ((then, f"`{flag}`"), (otherwise, f"not `{flag}`"))
        for rule in profile.rules
    )
    hit = f"if(`{flag}`, {then.any_fires()}, {otherwise.any_fires()})"
    one_row_per_rule = readings.where(hit).selectExpr(*keep, f"inline(array({fired}))")
    return one_row_per_rule.where("alert_type is not null")


def describe_alerts(candidates: DataFrame, profile: Profile) -> DataFrame:
    """Add ``threshold`` and ``alert_reason`` from type and value."""
    limits = " ".join(f"when '{r.alert_type}' then double('{r.threshold}')" for r in profile.rules)
    reasons = " ".join(f"when '{r.alert_type}' then {r.reason('value')}" for r in profile.rules)
    return candidates.selectExpr(
        "*",
        f"case alert_type {limits} end as threshold",
        f"case alert_type {reasons} end as alert_reason",
    )


def detect_alerts(readings: DataFrame, profile: Profile, *keep: str) -> DataFrame:
    """0 to 4 alerts per reading: (kept columns, type, value, threshold, reason)."""
    return describe_alerts(detect_candidates(readings, profile, *keep), profile)
