from datetime import datetime, timedelta

from sensorloom.operators.metrics import consumer_lag, latest_offsets, topic_list, topic_rates, topic_throughput

T0 = datetime(2024, 1, 1)


def test_rates_with_reset(spark):
    rows = []
    for second, a, b in ((0, 100, 5), (20, 140, 5), (40, 10, 25)):  # counter a starts again
        rows.append((T0 + timedelta(seconds=second), "x", "weather-data", a))
        rows.append((T0 + timedelta(seconds=second), "y", "weather-data", b))
    rows.append((T0 + timedelta(seconds=70), "x", "weather-data", 500))  # alone in its window
    samples = spark.createDataFrame(rows, "ts timestamp, instance string, topic string, count bigint")
    found = [tuple(r) for r in topic_rates(samples).collect()]
    assert found == [(T0, "weather-data", 70, (40 + 10) / 40 + 20 / 40)]


def test_throughput_lag_and_topics(spark):
    records = spark.createDataFrame([(T0, "t")] * 30 + [(T0, "")], "timestamp timestamp, topic string")
    rates = {r.topic: (r.n_messages, r.rate) for r in topic_throughput(records).collect()}
    assert rates["t"] == (30, 0.5)
    assert [r.topic for r in topic_list(records).collect()] == ["t"]
    offsets = spark.createDataFrame(
        [(T0, "g", "t", 0, 10, 7), (T0, "g", "t", 1, 5, None), (T0, "h", "t", 0, 10, 10)],
        "ts timestamp, group string, topic string, partition int, end_offset bigint, committed bigint",
    )
    assert {r.group: r.lag for r in consumer_lag(offsets).collect()} == {"g": 8, "h": 0}


def test_the_last_offsets_of_an_interval_count(spark):
    rows = [(T0, 0, 10, 7), (T0.replace(minute=30), 0, 20, 19), (T0.replace(minute=5), 1, 5, None)]
    offsets = spark.createDataFrame(
        [(t, "g", "t", p, end, done) for t, p, end, done in rows],
        "ts timestamp, group string, topic string, partition int, end_offset bigint, committed bigint",
    )
    assert [(r.ts, r.lag) for r in consumer_lag(latest_offsets(offsets)).collect()] == [(T0, 6)]
