"""The cooldown against a plain walk over sorted alerts."""

import re
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import cooldown as cd
from sensorloom.operators.cooldown import NEVER, block_steps, cooldown, join_steps, keep_from
from sensorloom.streaming.cooldown import stream_cooldown

SCHEMA = "event_id bigint, location string, alert_type string, event_time timestamp, value double"


def walk(rows, minutes, seed=None):
    """(location, type) -> kept event ids, by walking over all alerts in order."""
    last, kept = dict(seed or {}), set()
    for event_id, location, kind, time, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        key = (location, kind)
        if key not in last or time - last[key] >= timedelta(minutes=minutes):
            last[key] = time
            kept.add((event_id, kind))
    return kept


def kept_by(spark, rows, minutes, seed=None):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = cooldown(frame, minutes=minutes, seed=seed).collect()
    assert len(found) == len({(r.event_id, r.alert_type) for r in found})
    by_id = {(r[0], r[2]): tuple(r) for r in rows}
    for r in found:  # the payload belongs to the kept alert
        assert (r.event_id, r.location, r.alert_type, r.event_time, r.value) == by_id[(r.event_id, r.alert_type)]
    return {(r.event_id, r.alert_type) for r in found}


def at(minute):
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def test_known_chain(spark):
    rows = [(i, "A", "T", at(m), 1.0) for i, m in enumerate((0, 10, 29, 30, 59, 60, 61, 95))]
    rows += [(100 + i, "B", "T", at(m), 2.0) for i, m in enumerate((5, 34, 35))]
    assert kept_by(spark, rows, 30) == {(i, "T") for i in (0, 3, 5, 7, 100, 102)}


def test_seed_and_late(spark):
    rows = [(i, "A", "T", at(m), 1.0) for i, m in enumerate((20, 40, 59, 60, 95))]
    seed = spark.createDataFrame([("A", "T", at(0)), ("A", "T", at(30)), ("Z", "T", at(500))],
                                 "location string, alert_type string, event_time timestamp")
    assert kept_by(spark, rows, 30, seed) == {(3, "T"), (4, "T")}
    # a seed that is newer than every alert suppresses all of them
    newer = spark.createDataFrame([("A", "T", at(10_000))], seed.schema)
    assert kept_by(spark, rows, 30, newer) == set()


def test_ties_keep_the_first(spark):
    rows = [(5, "A", "T", at(0), 5.0), (3, "A", "T", at(0), 3.0), (4, "A", "T", at(30), 4.0), (9, "A", "T", at(30), 9.0)]
    assert kept_by(spark, rows, 30) == {(3, "T"), (4, "T")}


def test_hot_key_over_blocks_and_units(spark, monkeypatch):
    """A third of all alerts on one key, an alert every few seconds, many blocks and units."""
    monkeypatch.setattr(cd, "SPANS_PER_BLOCK", 4)
    monkeypatch.setattr(cd, "PARTS_PER_UNIT", 3)
    monkeypatch.setattr(cd, "HORIZON_MICROS", 20 * 86_400_000_000)
    rng = np.random.default_rng(7)
    start = datetime(1969, 12, 30)  # crosses zero
    rows = []
    for i in range(6000):
        location = "hot" if i % 3 == 0 else f"L{i % 40}"
        span = 200_000 if location == "hot" else 1_000_000
        rows.append((i, location, "T", start + timedelta(seconds=int(rng.integers(span))), float(i)))
    for minutes in (1, 7.5, 240):
        assert kept_by(spark, rows, minutes) == walk(rows, minutes)


def test_null_is_a_key_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(cd, "SPANS_PER_BLOCK", 3)
    monkeypatch.setattr(cd, "PARTS_PER_UNIT", 4)
    monkeypatch.setattr(cd, "HORIZON_MICROS", 20 * 86_400_000_000)
    rng = np.random.default_rng(11)
    start = datetime(1969, 12, 31, 12)
    rows = []
    for i in range(1500):
        location = (None, "hot", f"L{i % 17}")[i % 3]
        moment = int(rng.integers(60_000) if location == "hot" else rng.integers(200_000))
        rows.append((i, location, "T", start + timedelta(seconds=moment), float(i)))
    seed = spark.createDataFrame(
        [(None, "T", start + timedelta(seconds=30_000))], "location string, alert_type string, event_time timestamp"
    )
    assert kept_by(spark, rows, 13) == walk(rows, 13)
    assert kept_by(spark, rows, 13, seed) == walk(rows, 13, {(None, "T"): start + timedelta(seconds=30_000)})


def test_regular_spacing_never_merges_chains(spark, monkeypatch):
    monkeypatch.setattr(cd, "SPANS_PER_BLOCK", 2)
    monkeypatch.setattr(cd, "PARTS_PER_UNIT", 2)
    monkeypatch.setattr(cd, "HORIZON_MICROS", 20 * 86_400_000_000)
    rows = [(i, "A", "T", at(0) + timedelta(seconds=i), 0.0) for i in range(3000)]
    assert kept_by(spark, rows, 1) == walk(rows, 1)


def test_empty_input(spark):
    assert kept_by(spark, [(1, "A", "T", at(0), 0.0)], 30) == {(1, "T")}
    nothing = spark.createDataFrame([], SCHEMA)
    assert cooldown(nothing).count() == 0


def test_kept_alerts_are_kept_again(spark, sf):
    from sensorloom.plans.catalog import QUERIES

    kept = QUERIES["cooldown_alerts"](spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))
    assert cooldown(kept).count() == kept.count()


@settings(max_examples=300, deadline=None)
@given(
    times=st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True),
    gap=st.integers(1, 30),
    spans=st.integers(1, 4),
    before=st.integers(1, 60) | st.none(),
)
def test_blocks_agree_with_walk(times, gap, spans, before):
    """Step tables, joined in any grouping, lead to the state that a walk leads to."""
    times = np.array(sorted(times))
    width = gap * spans
    last = NEVER if before is None else -before
    tables, starts = [], []
    for block in np.unique(times // width):
        tables.append(block_steps(times[times // width == block], int(block) * width, gap))
        starts.append(int(block) * width)

    def after(table, state):
        upto, ends = table
        step = int(np.searchsorted(upto, state + gap))
        return int(ends[step]) if step < len(upto) else state

    kept = keep_from(times, last, gap)
    expected = int(times[kept[-1]]) if kept else last

    state = last
    for table in tables:
        state = after(table, state)
    assert state == expected
    assert after(join_steps(tables, starts[0], gap), last) == expected
    half = len(tables) // 2
    if half:
        pair = [join_steps(tables[:half], starts[0], gap), join_steps(tables[half:], starts[half], gap)]
        assert after(join_steps(pair, starts[0], gap), last) == expected
    # the rule itself
    chosen = times[kept]
    assert all(np.diff(chosen) >= gap)
    for t in set(times.tolist()) - set(chosen.tolist()):
        earlier = [c for c in [last, *chosen.tolist()] if c <= t]
        assert earlier and t - max(earlier) < gap


def test_layout_bounds_what_a_task_holds():
    for minutes, resolution in ((30, 1.0), (360, 1.0), (30, 0.001), (0.0001, 0.001), (30, 1e-6)):
        gap, unit = round(minutes * 60_000_000), round(resolution * 1_000_000)
        layout = cd.Layout.of(gap, unit)
        per_span = -(-gap // unit)
        assert layout.width % gap == 0
        assert layout.width // unit <= max(cd.BLOCK_INSTANTS, per_span)
        assert layout.arity * per_span <= max(cd.UNIT_STEPS, 2 * per_span)
        assert layout.width * layout.arity ** (layout.levels + 1) >= cd.HORIZON_MICROS
    assert cd.Layout.of(30 * 60_000_000, 1_000_000) == cd.Layout(256 * 30 * 60_000_000, 128, 1)


def test_step_tables_travel_in_bounded_rows(monkeypatch):
    monkeypatch.setattr(cd, "STEPS_PER_ROW", 7)
    schema = cd._arrow_schema([])
    upto, last = np.arange(30), np.arange(30) * 2
    rows = cd._step_rows([], schema, 5, upto, last)
    assert rows.num_rows == 5 and max(len(r) for r in rows.column("_upto").to_pylist()) == 7
    [(id_, one, two)] = list(cd._step_tables(rows))
    assert id_ == 5 and np.array_equal(one, upto) and np.array_equal(two, last)


def test_stream_state_is_seeded_and_given_up(spark, tmp_path):
    schema = "location string, alert_type string, event_id bigint, event_time timestamp"

    def rows(*times):
        found = [(place, "HEAT", n, f"2024-01-01 {t}") for n, (place, t) in enumerate(times)]
        texts = schema.replace("timestamp", "string")
        return spark.createDataFrame(found, texts).withColumn("event_time", F.to_timestamp("event_time"))

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    seed = rows(("a", "00:00:00"), ("a", "00:10:00"), ("b", "00:00:00"))
    parts = [
        rows(("a", "00:35:00"), ("a", "00:40:00"), ("b", "00:29:59"), ("c", "00:30:00")),
        rows(("d", "03:00:00")),
        rows(("a", "03:00:01"), ("d", "03:10:00"), ("c", "00:31:00")),  # the last one is late
    ]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        stream_cooldown(stream, seed=seed, delay="5 minutes")
        .writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(out, format="parquet")
    )
    query.awaitTermination()
    kept = {(r.location, str(r.event_time)[11:]) for r in spark.read.parquet(out).collect()}
    assert kept == {("a", "00:40:00"), ("c", "00:30:00"), ("d", "03:00:00"), ("a", "03:00:01")}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    # a, b and c are given up when the watermark reaches 02:55
    assert max(held) > held[-1] > 0


def test_short_blocks_get_their_rows_by_one_shuffle(spark):
    """Times of a key close together: the same alerts, ties and constant keys included."""
    start = datetime(2024, 1, 1)
    rows = [
        (n, f"L{n % 2}", "T", start + timedelta(milliseconds=(n * 37) % 5000), float(n)) for n in range(9000)
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for keyed, want in ((frame, rows), (frame.withColumn("location", F.lit("L")), [(r[0], "L", *r[2:]) for r in rows])):
        kept = cooldown(keyed, minutes=7 / 60_000, resolution=0.001)
        found = kept.collect()
        assert {(r.event_id, r.alert_type) for r in found} == walk(want, 7 / 60_000)
        assert all(r.value == r.event_id for r in found)
        # both uses of the rows have them by block from the one repartition
        dealt = re.findall(r"hashpartitioning\((.*?), \d+\), (\w+)", keyed_plan(kept))
        assert not [by for by, _ in dealt if "event_time" in by]
        assert {why for by, why in dealt if by.endswith("_block")} == {"REPARTITION_BY_COL"}


def keyed_plan(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)
