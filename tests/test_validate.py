import pytest

from sensorloom.operators.rules import ALERT_PROFILE, RETRY_PROFILE, detect_alerts
from sensorloom.operators.validate import (
    ERROR_CONTRACT,
    check_contract,
    file_counts,
    rejected_readings,
    valid_readings,
    with_verdict,
)
from sensorloom.schemas import RAW_COLUMNS

BASE = ("Dallas", "2024-01-01 00:00:00", "20.5", "50.0", "0.0", "5.0")
SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)

CASES = [
    ({}, None, None),
    ({"humidity_pct": ""}, "MISSING_FIELD", "Missing required field: Humidity_pct"),
    ({"humidity_pct": None}, "MISSING_FIELD", "Missing required field: Humidity_pct"),
    ({"humidity_pct": "abc_xyz"}, "TYPE_ERROR", "Invalid float field: Humidity_pct='abc_xyz'"),
    ({"location": "", "temperature_c": "abc_xyz"}, "MISSING_FIELD", "Missing required field: Location"),
    (
        {"temperature_c": "abc_xyz", "wind_speed_kmh": "abc_xyz"},
        "TYPE_ERROR",
        "Invalid float field: Temperature_C='abc_xyz'",
    ),
    ({"date_time": "2024-99-99 99:99:99"}, None, None),
    ({"date_time": "2024-1-1 0:0:0"}, None, None),
    ({"temperature_c": "nan"}, None, None),
    ({"temperature_c": "1.5f"}, "TYPE_ERROR", "Invalid float field: Temperature_C='1.5f'"),
    ({"temperature_c": " 2 "}, None, None),
    ({"temperature_c": "1_000"}, "TYPE_ERROR", "Invalid float field: Temperature_C='1_000'"),
]


def rows_of(spark, changes):
    rows = [tuple({**dict(zip(RAW_COLUMNS, BASE)), **c}.values()) for c in changes]
    return spark.createDataFrame([(i, "f.csv", *r) for i, r in enumerate(rows)], f"i int, file_name string, {SCHEMA}")


def test_verdicts(spark):
    raw = rows_of(spark, [c for c, _, _ in CASES])
    found = [(r.error_type, r.error_reason) for r in with_verdict(raw).orderBy("i").collect()]
    assert found == [(t, reason) for _, t, reason in CASES]
    ok = {i for i, (_, t, _) in enumerate(CASES) if t is None}
    assert {r.i for r in valid_readings(raw).collect()} == ok
    assert {r.i for r in rejected_readings(raw).collect()} == set(range(len(CASES))) - ok
    assert tuple(file_counts(raw).first()) == ("f.csv", len(ok), len(CASES) - len(ok))


def test_nan_raises_no_alert(spark):
    raw = rows_of(spark, [{"temperature_c": "nan"}, {"temperature_c": "inf"}])
    alerts = detect_alerts(valid_readings(raw), ALERT_PROFILE, "i").collect()
    assert [(a.i, a.alert_type) for a in alerts] == [(1, "TEMP_HIGH")]


@pytest.mark.parametrize(
    "profile, t, p, w, expected",
    [
        (ALERT_PROFILE, 35.0, 0.0, 0.0, ["TEMP_HIGH"]),
        (ALERT_PROFILE, 0.0, 30.0, 40.0, ["RAIN_HEAVY", "TEMP_LOW", "WIND_STRONG"]),
        (ALERT_PROFILE, None, 30.0, 0.0, ["RAIN_HEAVY"]),
        (ALERT_PROFILE, 20.0, 10.0, 10.0, []),
        (RETRY_PROFILE, None, 50.0, 50.0, []),
        (RETRY_PROFILE, 32.0, 0.0, 0.0, ["TEMP_HIGH"]),
        (RETRY_PROFILE, -999.0, 0.0, 0.0, ["TEMP_LOW"]),
    ],
)
def test_rules(spark, profile, t, p, w, expected):
    row = spark.createDataFrame(
        [(t, p, w)], "temperature_c double, precipitation_mm double, wind_speed_kmh double"
    )
    assert sorted(r.alert_type for r in detect_alerts(row, profile).collect()) == expected


def test_reason_texts(spark):
    row = spark.createDataFrame(
        [(36.6, 30.0, 41.5)], "temperature_c double, precipitation_mm double, wind_speed_kmh double"
    )
    found = {r.alert_type: r.alert_reason for r in detect_alerts(row, ALERT_PROFILE).collect()}
    assert found == {
        "TEMP_HIGH": "Temperature 36.6°C >= 35.0°C",
        "RAIN_HEAVY": "Rainfall 30.0mm >= 30.0mm",
        "WIND_STRONG": "Wind 41.5 km/h >= 40.0 km/h",
    }


def test_contract_quarantine(spark):
    rows = spark.createDataFrame(
        [
            (1, "T", "m", "{}", "Dallas", "f", "NEW"),
            (2, "T", "m", None, "Dallas", "f", "NEW"),
            (3, "T" * 51, "m", "{}", None, None, "NEW"),
            (4, "T", "m", "{}", "x" * 51, "f", "NEW"),
        ],
        "id int, error_type string, error_message string, raw_row string, location string, "
        "file_name string, processing_status string",
    )
    fits, broken = check_contract(rows, ERROR_CONTRACT)
    assert [r.id for r in fits.collect()] == [1]
    assert {r.id: r.violation for r in broken.collect()} == {
        2: "raw_row is null",
        3: "error_type is longer than 50",
        4: "location is longer than 50",
    }
