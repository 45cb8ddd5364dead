"""Cooldown: per key, an alert is kept only if none was kept in the span before it.

The rule is a greedy chain: a kept alert starts a span of ``minutes``; alerts inside the span
are suppressed and do not extend it. Whether one alert is kept depends on all before it, so a
plain window expression cannot say it, and one key may hold a large share of all rows, so a
key cannot be worked off in one task either. The chain is therefore cut into time blocks:

1. Of the alerts of one key at one instant only the first can be kept. An aggregation over
   (key, instant), combined before its shuffle, spreads a hot key over all tasks and leaves at
   most one row per instant. Where blocks hold few instants, so that a key's many blocks spread it
   already, rows go to their block at once and the first of an instant is found there by a sort:
   one shuffle of the rows in place of two.
2. Each (key, block of some spans) is summed up on its own as a step table: for every instant at
   which the key may become ready inside the block, the last alert kept in the block. Equal
   neighbours are merged.
3. The step tables of neighbouring blocks are joined to one table per unit, by feeding the outcome
   of one block into the next; units are joined to larger units until few are left per key.
4. The largest units are replayed per key, then each unit's parts, down to the blocks, which gives
   the state at the start of every block; only step tables are involved.
5. Each (key, block) then keeps its alerts on its own, from its known start.

How many spans make a block and how many parts a unit follows from the resolution of the times, so
that no task holds more than a fixed number of instants or steps, whatever the key's share of the
rows. Step tables travel in rows of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.once import once

SPANS_PER_BLOCK = 256
PARTS_PER_UNIT = 128
# Instants that a block may hold, and steps that a unit may, at the stated resolution.
BLOCK_INSTANTS = 1 << 19
UNIT_STEPS = 1 << 23
STEPS_PER_ROW = 1 << 16
# Blocks of at most so many instants get their rows by one shuffle.
DIRECT_INSTANTS = 1 << 14
# The time that units are laid out for: longer tables only make the last replay longer.
HORIZON_MICROS = 20 * 366 * 86_400_000_000
NEVER = -(1 << 62)  # "no alert kept yet", far before any timestamp

_STEP_FIELDS = "_id bigint, _row int, _upto array<bigint>, _last array<bigint>"


@dataclass(frozen=True)
class Layout:
    """Microseconds of a block, parts of a unit, how often units are joined to larger ones, and whether
    rows go to their block by one shuffle."""

    width: int
    arity: int
    levels: int
    direct: bool = False

    @staticmethod
    def of(gap: int, resolution: int) -> Layout:
        """At seconds and 30 minutes: blocks of 256 spans, and one level of units of 128 blocks."""
        instants = max(1, -(-gap // resolution))  # that a span may hold
        spans = min(max(BLOCK_INSTANTS // instants, 1), SPANS_PER_BLOCK)
        arity = min(max(UNIT_STEPS // instants, 2), PARTS_PER_UNIT)
        blocks, levels = -(-HORIZON_MICROS // (gap * spans)), 1
        while blocks > arity ** (levels + 1):
            levels += 1
        return Layout(gap * spans, arity, levels, spans * instants <= DIRECT_INSTANTS)


# --- helpers on sorted instants (microseconds) ------------------------------------------------
def keep_from(times: np.ndarray, last: int, gap: int) -> list[int]:
    """Positions of the kept alerts, given the last alert kept before."""
    kept = []
    at = int(np.searchsorted(times, last + gap))
    while at < len(times):
        kept.append(at)
        at = int(np.searchsorted(times, times[at] + gap))
    return kept


def _merge_equal(upto: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.append(last[1:] != last[:-1], True)
    return upto[ends], last[ends]


def block_steps(times: np.ndarray, start: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Step table of one block: ready at or before ``upto`` -> last kept alert is ``last``.

    The key is ready at the latest one span after the block starts, so only the alerts up to
    the first one after that instant can open the chain.
    """
    here = np.arange(len(times))
    follower = np.searchsorted(times, times + gap)
    final = np.where(follower < len(times), follower, here)
    while True:  # double the hops until every alert points at the end of its chain
        further = final[final]
        if np.array_equal(further, final):
            break
        final = further
    openers = min(int(np.searchsorted(times, start + gap)) + 1, len(times))
    return _merge_equal(times[:openers], times[final[:openers]])


def join_steps(
    tables: Sequence[tuple[np.ndarray, np.ndarray]], start: int, gap: int
) -> tuple[np.ndarray, np.ndarray]:
    """One step table for consecutive blocks, the first of which begins at ``start``."""
    upto, last = tables[0]
    for next_upto, next_last in tables[1:]:
        step = np.searchsorted(next_upto, last + gap)
        inside = step < len(next_upto)
        last = np.where(inside, next_last[np.minimum(step, len(next_upto) - 1)], last)
        if upto[-1] < start + gap:  # ready only after all alerts so far: the next block opens
            upto, last = np.append(upto, next_upto[0]), np.append(last, next_last[0])
        upto, last = _merge_equal(upto, last)
    return upto, last


# --- Arrow group functions --------------------------------------------------------------------
def _step_rows(key: list, schema: pa.Schema, id_: int, upto: np.ndarray, last: np.ndarray) -> pa.Table:
    """One step table as rows of at most ``STEPS_PER_ROW`` steps."""
    starts = range(0, len(upto), STEPS_PER_ROW)
    columns = [pa.array([k] * len(starts), f.type) for k, f in zip(key, schema)]
    columns.append(pa.array([id_] * len(starts), pa.int64()))
    columns.append(pa.array(range(len(starts)), pa.int32()))
    for steps in (upto, last):
        rows = [steps[n : n + STEPS_PER_ROW] for n in starts]
        columns.append(pa.array(rows, pa.list_(pa.int64())))
    return pa.Table.from_arrays(columns, schema=schema)


def _step_tables(group: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The step tables of a group in the order of their ids."""
    group = group.sort_by([("_id", "ascending"), ("_row", "ascending")])
    ids = group.column("_id").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else []
    for start, stop in zip(starts, [*starts[1:], len(ids)]):
        part = group.slice(start, stop - start)
        steps = [np.concatenate([r.values.to_numpy() for r in part.column(c)]) for c in ("_upto", "_last")]
        yield int(ids[start]), *steps


def _arrow_schema(fields: list[T.StructField]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    plain = to_arrow_schema(T.StructType(fields))
    for name, kind in (("_id", pa.int64()), ("_row", pa.int32())):
        plain = plain.append(pa.field(name, kind))
    for name in ("_upto", "_last"):
        plain = plain.append(pa.field(name, pa.list_(pa.int64())))
    return plain


def _steps_of_block(schema: pa.Schema, width: int, gap: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        *own, block = (k.as_py() for k in key)
        times = np.sort(group.column("_t").to_numpy())
        return _step_rows(own, schema, block, *block_steps(times, block * width, gap))

    return run


def _steps_of_unit(schema: pa.Schema, width: int, gap: int):
    """``width`` is that of the parts."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        *own, unit = (k.as_py() for k in key)
        parts = list(_step_tables(group))
        tables = [steps for _, *steps in parts]
        return _step_rows(own, schema, unit, *join_steps(tables, parts[0][0] * width, gap))

    return run


def _replay(group: pa.Table, last: int, gap: int) -> tuple[list[int], list[int]]:
    """The state before each part of a unit that starts with the state ``last``."""
    ids, states = [], []
    for id_, upto, kept in _step_tables(group):
        ids.append(id_)
        states.append(last)
        step = int(np.searchsorted(upto, last + gap))
        if step < len(upto):
            last = int(kept[step])
    return ids, states


def _state_rows(key: list, schema: pa.Schema, ids: list[int], states: list[int]) -> pa.Table:
    columns = [pa.array([k] * len(ids), f.type) for k, f in zip(key, schema)]
    columns += [pa.array(ids, pa.int64()), pa.array(states, pa.int64())]
    names = [f.name for f in schema][: len(key)] + ["_id", "_state"]
    return pa.Table.from_arrays(columns, names=names)


def _first_states(schema: pa.Schema, gap: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        return _state_rows([k.as_py() for k in key], schema, *_replay(group, NEVER, gap))

    return run


def _part_states(schema: pa.Schema, gap: int):
    def run(key: tuple, parts: pa.Table, state: pa.Table) -> pa.Table:
        start = state.column("_state")[0].as_py()
        return _state_rows([k.as_py() for k in key[:-1]], schema, *_replay(parts, start, gap))

    return run


def _keep_in_block(gap: int, columns: list[str]):
    def run(events: pa.Table, state: pa.Table) -> pa.Table:
        events = events.sort_by("_t")
        last = state.column("_state")[0].as_py() if state.num_rows else NEVER
        kept = keep_from(events.column("_t").to_numpy(), last, gap)
        return events.take(pa.array(kept, pa.int64())).select(columns)

    return run


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(other, same, "left").drop(*[f"_right_{c}" for c in on])


def first_per_instant(
    candidates: DataFrame, keys: Sequence[str], time: str, tie: str
) -> DataFrame:
    """One row per (key, instant): the one with the smallest ``tie``."""
    rest = [c for c in candidates.columns if c not in (*keys, time, tie)]
    return candidates.groupBy(*keys, time).agg(
        F.min(tie).alias(tie), *[F.min_by(c, tie).alias(c) for c in rest]
    )


def first_in_block(candidates: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """The same rows, dealt by (key, block): one sort serves this and what is grouped by block.

    Keys go through ``once``: a constant key would be folded out of the plan, and rows that are dealt
    by a constant count as dealt in another way than those grouped by its column.
    """
    columns = candidates.columns
    plain = candidates.withColumnsRenamed({k: f"_own_{k}" for k in keys})
    candidates = once(plain, **{k: F.col(f"_own_{k}") for k in keys}).select(columns)
    instant = Window.partitionBy(*keys, "_block", time).orderBy(F.col(tie).asc_nulls_last())
    dealt = candidates.repartition(*keys, "_block").withColumn("_n", F.row_number().over(instant))
    return dealt.where("_n = 1").drop("_n")


def cooldown(
    candidates: DataFrame,
    *,
    keys: Sequence[str] = ("location", "alert_type"),
    time: str = "event_time",
    tie: str = "event_id",
    minutes: float = 30,
    seed: DataFrame | None = None,
    resolution: float = 1.0,
) -> DataFrame:
    """The kept alerts, with all their columns.

    ``time`` must be a timestamp and is not null on any row. ``tie`` orders alerts of one key
    at one instant. ``seed`` holds (keys, ``time``) of alerts kept earlier, of which the latest
    per key counts; an alert earlier than one span after it is suppressed, also when it is
    older (late). Keep the columns few and numeric: they go through the shuffle.

    ``resolution`` is the usual distance of distinct times in seconds; tasks are laid out for it.
    Times that are closer give the same alerts, with larger tasks.
    """
    keys = list(keys)
    gap = round(minutes * 60_000_000)
    if gap <= 0:
        raise ValueError("the cooldown must be longer than zero")
    layout = Layout.of(gap, max(1, round(resolution * 1_000_000)))
    columns = candidates.columns
    micros = F.unix_micros(F.col(time))

    def part_of(t: Column, size: int) -> Column:  # floor division, also before 1970
        return F.call_function("div", t - F.pmod(t, F.lit(size)), F.lit(size))

    firsts = candidates if layout.direct else first_per_instant(candidates, keys, time, tie)
    if seed is not None:
        # what lies before the end of the seed's span is suppressed for sure, and the chain of
        # the rest starts without a state
        latest = seed.groupBy(*keys).agg(F.unix_micros(F.max(time)).alias("_seed"))
        ready = F.col("_seed").isNull() | (micros >= F.col("_seed") + gap)
        firsts = _null_safe_join(firsts, latest, keys).where(ready).drop("_seed")
    events = firsts.withColumn("_block", part_of(micros, layout.width))
    if layout.direct:
        events = first_in_block(events, keys, time, tie)
    events = events.withColumn("_t", micros)

    key_fields = [candidates.schema[k] for k in keys]
    key_ddl = T.StructType(key_fields).simpleString()[len("struct<") : -1]
    schema = _arrow_schema(key_fields)
    step_ddl, state_ddl = f"{key_ddl},{_STEP_FIELDS}", f"{key_ddl},_id bigint,_state bigint"

    width = layout.width
    tables = [
        events.groupBy(*keys, "_block").applyInArrow(_steps_of_block(schema, width, gap), step_ddl)
    ]
    unit = part_of(F.col("_id"), layout.arity)
    for _ in range(layout.levels):
        parts = tables[-1].withColumn("_unit", unit)
        joined = parts.groupBy(*keys, "_unit").applyInArrow(
            _steps_of_unit(schema, width, gap), step_ddl
        )
        tables.append(joined)
        width *= layout.arity

    states = tables.pop().groupBy(*keys).applyInArrow(_first_states(schema, gap), state_ddl)
    while tables:
        parts = tables.pop().withColumn("_unit", unit).groupBy(*keys, "_unit")
        states = parts.cogroup(states.groupBy(*keys, "_id")).applyInArrow(
            _part_states(schema, gap), state_ddl
        )

    kept_schema = T.StructType([candidates.schema[c] for c in columns])
    return (
        events.groupBy(*keys, "_block")
        .cogroup(states.groupBy(*keys, "_id"))
        .applyInArrow(_keep_in_block(gap, columns), kept_schema)
    )


def latest_alerts(alerts: DataFrame, keys: Sequence[str] = ("location", "alert_type")) -> DataFrame:
    """Seed for :func:`cooldown` from an alerts table."""
    return alerts.groupBy(*keys).agg(F.max("event_time").alias("event_time"))
