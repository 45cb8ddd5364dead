import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sensorloom.functions.text import alert_text, error_text, pretty_json, retry_text
from sensorloom.operators.outbox import Outbox, Schedule, apply_acks

T0 = datetime(2024, 1, 1)


def errors(spark, count):
    rows = [
        (i, "TYPE_ERROR", f"m{i}", '{"Location":"제주","retry":0,"T":"2.0","N":null}', "제주", "f.csv", False, None, T0.replace(minute=i))
        for i in range(1, count + 1)
    ]
    return spark.createDataFrame(
        rows,
        "id bigint, error_type string, error_message string, raw_row string, location string, "
        "file_name string, slack_sent boolean, slack_sent_at timestamp, created_at timestamp",
    )


def test_cycles(spark, tmp_path):
    log, down = tmp_path / "log", tmp_path / "down"
    log.mkdir()
    down.write_text("")

    def sender(text):
        if text == "m3" and os.path.exists(down):
            raise ConnectionError("no answer")
        with open(log / f"{text}-{os.getpid()}-{os.urandom(4).hex()}", "w"):
            pass
        return True

    def sent():
        return sorted(int(n.split("-")[0][1:]) for n in os.listdir(log))

    box = Outbox(str(tmp_path / "box"))
    box.add(errors(spark, 12))
    message = F.col("error_message")
    assert box.drain_once(spark, message, sender) == 10
    assert sent() == [1, 2, 4, 5, 6, 7, 8, 9, 10]
    os.rename(down, tmp_path / "up")
    box.compact(spark)
    assert box.drain_once(spark, message, sender) == 3
    assert sent() == list(range(1, 13))
    assert box.drain_once(spark, message, sender) == 0
    box.compact(spark)
    state = box.state(spark).collect()
    assert len(state) == 12 and all(r.slack_sent and r.slack_sent_at for r in state)


def test_a_cycle_reads_no_folder_before_the_backlog(spark, tmp_path):
    box = Outbox(str(tmp_path / "box"))
    days = errors(spark, 30).withColumn(
        "created_at", F.col("created_at") + F.make_dt_interval(F.floor(F.col("id") / 10).cast("int"))
    )
    box.add(days)
    assert box.low_water(spark) is None
    for _ in range(2):
        assert box.drain_once(spark, F.col("error_message"), lambda text: True) == 10
    assert box.low_water(spark) == T0.date() + timedelta(days=1)
    text = box.state(spark, box.low_water(spark))._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters:")[1].split("]")[0]
    assert "date" in filters and "2024-01-02" in filters
    # A row of an older day moves the mark back, so it is not passed over.
    box.add(errors(spark, 1).withColumn("id", F.lit(99).cast("bigint")))
    assert box.low_water(spark) == T0.date()
    while box.drain_once(spark, F.col("error_message"), lambda text: True):
        pass
    assert box.state(spark).where("not slack_sent").count() == 0


def test_first_acknowledgement_counts(spark):
    acks = spark.createDataFrame(
        [(1, T0.replace(hour=5)), (1, T0.replace(hour=4))], "id bigint, sent_at timestamp"
    )
    state = {r.id: r.slack_sent_at for r in apply_acks(errors(spark, 2), acks).collect()}
    assert state == {1: T0.replace(hour=4), 2: None}


def test_error_text(spark):
    text = errors(spark, 1).select(error_text().alias("t")).first().t
    assert text == (
        "🚨 *Error Detected*\n"
        "• Type: `TYPE_ERROR`\n"
        "• Location: `제주`\n"
        "• File: `f.csv`\n"
        "• Reason: m1\n"
        '• Raw Row: ```{\n  "Location": "제주",\n  "retry": 0,\n  "T": "2.0",\n  "N": null\n}```\n'
        "• Time: 2024-01-01 00:01:00"
    )


def test_alert_texts(spark):
    row = spark.createDataFrame(
        [("OTHER_KIND", "Dallas", "why", T0, T0, T0.replace(minute=1), 2)],
        "alert_type string, location string, alert_reason string, event_time timestamp, "
        "window_start timestamp, window_end timestamp, retry_count int",
    )
    alert, retry = row.select(alert_text(), retry_text()).first()
    assert alert == (
        "⚠️ *OTHER KIND Alert*\nLocation: Dallas\nwhy\nEvent Time: 2024-01-01 00:00:00\n"
        "Window: 2024-01-01 00:00:00 ~ 2024-01-01 00:01:00"
    )
    assert retry == "♻️ *Retry Alert (2)*\nLocation: Dallas\nwhy\nTime: 2024-01-01 00:00:00"


def test_pretty_json_like_python(spark):
    texts = [
        '{"a": 1, "b": {"c": [1, 2.5, "x", null, true, {}], "d": {}}, "e": [], "q\\"k": "l\\nm", "ü": "제주"}',
        '[1, {"a": [[1], []]}]', "{}", "[]", '"text"', "12", '{"n": null, "t": "{}", "u": "[1]"}',
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "raw string")
    shown = [r[0] for r in rows.select(pretty_json("raw")).collect()]
    assert shown == [json.dumps(json.loads(t), indent=2, ensure_ascii=False) for t in texts]
    other = spark.createDataFrame([("no json",), ("{broken",), (None,)], "raw string")
    assert [r[0] for r in other.select(pretty_json("raw")).collect()] == ["no json", "{broken", None]


def test_failed_rows_step_back(spark, tmp_path):
    """Rows that fail are due again after a time that doubles; others are sent in between."""
    box = Outbox(str(tmp_path / "box"), schedule=Schedule(base=60.0, longest=150.0))
    box.add(errors(spark, 4))

    def drain(seconds, limit=2):
        moment = F.lit(T0 + timedelta(seconds=seconds)).cast("timestamp")
        return box.drain_once(spark, F.col("error_message"), lambda t: t not in ("m1", "m2"), limit, moment)

    assert [drain(0), drain(1), drain(2), drain(59)] == [2, 2, 0, 0]
    assert [drain(61), drain(100), drain(182)] == [2, 0, 2]
    assert [drain(330), drain(333), drain(400), drain(484)] == [0, 2, 0, 2]  # no longer than 150
    box.compact(spark)
    assert [drain(500), drain(635)] == [0, 2]
    found = {r.id: (r.n_sent, r.n_failed) for r in box.outcomes(spark).collect()}
    assert found == {1: (0, 6), 2: (0, 6), 3: (1, 0), 4: (1, 0)}


def test_a_claim_holds_until_its_lease_ends(spark, tmp_path):
    """Rows of a drainer that was lost after its pick are another's when the lease is over."""
    box = Outbox(str(tmp_path / "box"), lease_seconds=100.0)
    box.add(errors(spark, 3))
    lost = Outbox(str(tmp_path / "box"), lease_seconds=100.0)
    start = F.lit(T0).cast("timestamp")
    turn, rows = lost._claim(spark, None, F.col("error_message"), 2, start)
    assert (turn, rows.count()) == (1, 2)

    def drain(seconds):
        moment = F.lit(T0 + timedelta(seconds=seconds)).cast("timestamp")
        return box.drain_once(spark, F.col("error_message"), lambda t: True, 10, moment)

    assert [drain(1), drain(2), drain(99), drain(101)] == [1, 0, 0, 2]
    assert {r.n_sent for r in box.outcomes(spark).collect()} == {1}


def test_one_drainer_gets_a_turn(spark, tmp_path):
    """Two drainers that picked at the same time: the second finds the turn taken, and picks again."""
    path = str(tmp_path / "box")
    box, other = Outbox(path), Outbox(path)
    box.add(errors(spark, 3))
    now = F.lit(T0).cast("timestamp")
    waiting = other._waiting

    def late(*args):
        other._waiting = waiting  # the other drainer's pick comes in between, once
        found = waiting(*args)
        assert box._claim(spark, None, F.col("error_message"), 2, now)[0] == 1
        return found

    other._waiting = late
    turn, rows = other._claim(spark, None, F.col("error_message"), 2, now)
    assert turn == 2 and [r.id for r in rows.collect()] == [3]


def test_a_backlog_is_drained_by_runs_of_turns(spark, tmp_path):
    """Calls grow with the logarithm of the backlog; turns stay at their limit, in the order of time."""
    path = str(tmp_path / "box")
    boxes = [Outbox(path, schedule=Schedule(base=60.0)) for _ in range(2)]
    many = spark.range(1, 201).join(errors(spark, 1).drop("id"))
    rows = many.withColumn("created_at", F.col("created_at") + F.make_dt_interval(mins=(200 - F.col("id")).cast("int")))
    boxes[0].add(rows)
    now = F.lit(T0.replace(year=2025)).cast("timestamp")

    def sender(text):
        return int(text) % 100 != 0

    picked = []
    while n := boxes[len(picked) % 2].drain_once(spark, F.col("id").cast("string"), sender, 5, now, share=0.5):
        picked.append(n)
    assert picked == [100, 50, 25, 15, 5, 5]
    turns = boxes[0]._acks(spark).groupBy("turn").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    found = [tuple(r) for r in turns.orderBy("turn").collect()]
    assert found == [(t, 5, 201 - 5 * t, 205 - 5 * t) for t in range(1, 41)]
    assert boxes[1].state(spark).where("not slack_sent").count() == 2
    later = now + F.expr("interval 61 seconds")
    assert boxes[0].drain_once(spark, F.col("id").cast("string"), sender, 5, later, share=1.0) == 2
    assert boxes[0]._claims(spark).agg(F.max("turn")).first()[0] == 41
    assert {(r.n_sent, r.n_failed) for r in boxes[0].outcomes(spark).collect()} == {(1, 0), (0, 2)}


def test_a_run_sends_a_repeated_id_in_one_turn(spark, tmp_path):
    box = Outbox(str(tmp_path / "box"))
    rows = errors(spark, 4)
    box.add(rows.unionByName(rows))
    assert box.drain_once(spark, F.col("error_message"), lambda t: True, 3, share=1.0) == 7
    found = {r.id: (r.n_sent, r.n_failed) for r in box.outcomes(spark).collect()}
    assert found == {1: (2, 0), 2: (1, 0), 3: (2, 0), 4: (2, 0)}
    assert box.drain_once(spark, F.col("error_message"), lambda t: True, 3, share=1.0) == 0
