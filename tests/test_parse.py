import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorloom.functions.parse import (
    event_time_lenient,
    event_time_strict,
    float_text,
    iso_text,
    iso_time,
    parse_float,
    parse_int_or_zero,
    retry_sql,
)


def evaluate(spark, schema, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {schema}")
    return [r[1] for r in sorted(rows.select("i", column.alias("y")).collect())]


def test_floats(spark):
    texts = ["1.5", " 2 ", ".5", "5.", "1e5", "-3", "1.5f", "1.5d", "1_000", "", "abc_xyz", "0x1p3", None]
    expected = [1.5, 2.0, 0.5, 5.0, 1e5, -3.0] + [None] * 7
    assert evaluate(spark, "string", texts, parse_float("x")) == expected
    odd = evaluate(spark, "string", ["nan", "-NaN", "inf", "-Infinity"], parse_float("x"))
    assert math.isnan(odd[0]) and math.isnan(odd[1]) and odd[2:] == [math.inf, -math.inf]


def test_integers(spark):
    texts = ["7", " -7 ", "+1", "3.7", "abc", "", None, "99999999999999999999"]
    assert evaluate(spark, "string", texts, parse_int_or_zero("x")) == [7, -7, 1, 0, 0, 0, 0, 0]


def test_retry_numbers(spark):
    texts = ["2", "2.0", "2.9", "x", "nan", None]
    assert evaluate(spark, "string", texts, F.expr(retry_sql("x"))) == [2, 2, 2, None, None, None]


@pytest.mark.parametrize(
    "text, lenient, strict",
    [
        ("2024-01-01 00:00:00", True, True),
        ("2024-99-99 99:99:99", False, False),
        ("2024-1-1 0:0:0", True, True),
        ("2024-01-01T00:00:00", True, False),
        ("2024-01-01  00:00:00", False, True),
        ("2024-001-01 00:00:00", False, False),
        ("2024-01-01 00:00:60", False, False),
        ("2024-01-01 00:00:00.5", True, False),
        ("2024-01-01", True, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_date_rules(spark, text, lenient, strict):
    found = evaluate(spark, "string", [text], event_time_lenient("x")) + evaluate(
        spark, "string", [text], event_time_strict("x")
    )
    assert [f is not None for f in found] == [lenient, strict]


def test_iso_texts(spark):
    times = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60)]
    assert evaluate(spark, "timestamp", times, iso_text("x")) == [t.isoformat() for t in times]
    texts = [t.isoformat() for t in times] + ["2024-01-02", "2024", "20 Jan", "2024-01-02T99:00:00", None]
    assert evaluate(spark, "string", texts, iso_time("x")) == times + [datetime(2024, 1, 2)] + [None] * 4


def test_float_texts(spark):
    numbers = [35.0, -0.5, 0.0, 12345678.9, 1e7, 1.5e-4, 123456789012345.6, 0.1 + 0.2]
    assert evaluate(spark, "double", numbers, float_text("x")) == [repr(n) for n in numbers]
