import json

from sensorloom.operators.deadletter import error_rows
from sensorloom.operators.retry import decode_message, retry_alerts, retry_dead_letters, retry_republish, with_failure

BASE = {
    "Location": "Dallas",
    "Date_Time": "2024-01-01 00:00:00",
    "Temperature_C": 20.0,
    "Humidity_pct": 50.0,
    "Precipitation_mm": 0.0,
    "Wind_Speed_kmh": 0.0,
    "retry": 0.0,
    "event_time": "2024-01-01T00:00:00",
}


def judged(spark, messages, rate=0.0):
    values = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    frame = spark.createDataFrame(list(enumerate(values)), "id bigint, value string")
    return with_failure(decode_message(frame, "id"), "id", fail_rate=rate)


def without(key):
    return {k: v for k, v in BASE.items() if k != key}


def test_absent_null_and_text_numbers(spark):
    rows = judged(
        spark,
        [
            without("Temperature_C"),
            {**BASE, "Temperature_C": None, "Precipitation_mm": 50, "Wind_Speed_kmh": 50},
            {**BASE, "Temperature_C": "32"},
            {**BASE, "Temperature_C": "x", "Wind_Speed_kmh": 99},
            {**BASE, "Temperature_C": float("nan"), "Wind_Speed_kmh": 99},
        ],
    )
    alerts = {(a.id, a.alert_type, a.value, a.retry_count) for a in retry_alerts(rows, "id", minutes=0.001).collect()}
    # all five share one instant; wind and temperature are kept once each, by the smallest id
    assert alerts == {(0, "TEMP_LOW", -999.0, 1), (2, "TEMP_HIGH", 32.0, 1), (4, "WIND_STRONG", 99.0, 1)}


def test_failures(spark):
    rows = judged(
        spark,
        [
            without("event_time"),
            {**BASE, "event_time": "yesterday", "retry": 2.0},
            {**BASE, "event_time": None},
            {**BASE, "retry": "x"},
            {**BASE, "retry": None},
            "no json",
            BASE,
            without("Location"),
        ],
    )
    found = {r.id: (r.failure, r.retry_count, r.location) for r in rows.collect()}
    assert found == {
        0: ("'event_time'", 1, "Dallas"),
        1: ("Invalid isoformat string: 'yesterday'", 3, "Dallas"),
        2: ("fromisoformat: argument must be str", 1, "Dallas"),
        3: ("Invalid retry count: x", 1, "Dallas"),
        4: ("Invalid retry count: None", 1, "Dallas"),
        5: ("Invalid message", 1, None),
        6: (None, 1, "Dallas"),
        7: (None, 1, "unknown"),
    }
    letters = {r.id: json.loads(r.value) for r in retry_dead_letters(rows, "id").collect()}
    assert set(letters) == {0, 1, 2, 3, 4, 5}
    assert letters[1] == {
        "error_type": "CONSUMER3_RETRY_FAIL",
        "error_reason": "Invalid isoformat string: 'yesterday'",
        "raw_row": {**BASE, "event_time": "yesterday", "retry": 2.0},
        "file_name": "processed_by_consumer3",
        "retry_count": 3,
    }
    assert letters[5]["raw_row"] == "no json"


def test_all_fail_at_rate_one(spark):
    assert {r.failure for r in judged(spark, [BASE, BASE], rate=1.0).collect()} == {
        "Intentional Chaos Error (Simulated Failure)"
    }


def test_republish_stops_at_the_limit(spark):
    rows = judged(spark, [{**BASE, "retry": n} for n in range(4)])
    sent = {r.id: json.loads(r.value)["retry"] for r in retry_republish(rows, 3, "id").collect()}
    assert sent == {0: 1, 1: 2}


def test_dead_letter_rows(spark):
    envelope = {
        "error_type": "MISSING_FIELD",
        "error_reason": "Missing required field: Humidity_pct",
        "raw_row": {"Location": "Jeju", "Humidity_pct": "", "retry": 0},
        "timestamp": 1704067200.5,
        "file_name": "sample.csv",
    }
    values = [(1, json.dumps(envelope)), (2, json.dumps({**envelope, "raw_row": None, "retry_count": 4}))]
    rows = {r.id: r for r in error_rows(spark.createDataFrame(values, "id int, value string"), "id").collect()}
    first = rows[1]
    assert (first.error_message, first.location, first.retry_count, first.processing_status, first.slack_sent) == (
        "Missing required field: Humidity_pct",
        "Jeju",
        0,
        "NEW",
        False,
    )
    assert json.loads(first.raw_row) == envelope["raw_row"]
    assert first.detected_at.microsecond == 500_000
    assert rows[2].raw_row is None and rows[2].location is None and rows[2].retry_count == 4
