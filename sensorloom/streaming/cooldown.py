"""The cooldown of a stream: as keyed state, or per micro-batch with the batch operator.

Keyed state has the lower latency and suits limited micro-batches, because one task handles all
alerts of a key in a micro-batch. Where a micro-batch may be of any size, such as when a stream
catches up on its history, :func:`start_cooldown` spreads a hot key over all tasks.

Keyed state may start from stored alerts, and may be given up once the watermark has passed the end
of a key's span. Expiry goes by event time and not by the clock: a stream that stands still, or
that catches up, would forget an alert too early or too late by the clock.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.cooldown import NEVER, cooldown, keep_from
from ..session import read_or_empty


class CooldownProcessor(StatefulProcessor):
    """Keeps the time of the last kept alert per key, and nothing else.

    Within a micro-batch alerts are taken in event-time order. An alert that is late against
    the state is suppressed, also when it comes from a later micro-batch. Of equal instants only
    the first can be kept, so a hot key holds one row per instant of the micro-batch, whose
    size the source limits.

    With ``expire`` a key without an alert for one span before the watermark has no state: what
    comes later than the watermark is ready anyway, and what comes earlier is dropped as late.
    """

    def __init__(self, gap: int, tie: str, columns: Sequence[str], expire: bool = False):
        self.gap = gap
        self.tie = tie
        self.columns = list(columns)
        self.expire = expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        state = T.StructType([T.StructField("micros", T.LongType())])
        self.handle = handle
        self.last = handle.getValueState("last", state)

    def _end_of_span(self, micros: int) -> int:
        """In milliseconds, not before the key is ready."""
        return -(-(micros + self.gap) // 1000)

    def _remember(self, micros: int, before: int | None) -> None:
        self.last.update((micros,))
        if self.expire:
            if before is not None:
                self.handle.deleteTimer(self._end_of_span(before))
            self.handle.registerTimer(self._end_of_span(micros))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._remember(int(initialState["seed_micros"].max()), None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def _first_per_instant(self, frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values(["at_micros", self.tie]).drop_duplicates("at_micros")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self._first_per_instant(pd.concat([self._first_per_instant(r) for r in rows]))
        times = frame["at_micros"].to_numpy()
        known = self.last.get()[0] if self.last.exists() else None
        kept = keep_from(times, NEVER if known is None else known, self.gap)
        if kept:
            self._remember(int(times[kept[-1]]), known)
            yield frame.iloc[kept][self.columns]

    def close(self) -> None:
        pass


def stream_cooldown(
    candidates: DataFrame,
    *,
    keys: Sequence[str] = ("location", "alert_type"),
    time: str = "event_time",
    tie: str = "event_id",
    minutes: float = 30,
    seed: DataFrame | None = None,
    delay: str | None = None,
) -> DataFrame:
    """The kept alerts of a stream of candidates; same rule as the batch operator.

    ``seed`` holds (keys, ``time``) of alerts kept before the stream began; it is read when a
    checkpoint is new and not again. ``delay`` is how late a candidate may come: candidates
    behind the watermark are dropped, and keys that it has left a span behind give up their state.
    Without it nothing is late and every key's state stays.
    """
    keys, columns = list(keys), candidates.columns
    if delay is not None:
        candidates = candidates.withWatermark(time, delay)
    # The time itself stays in the rows, as the watermark goes by it.
    timed = candidates.withColumn("at_micros", F.unix_micros(time))
    kept_schema = T.StructType([f for f in timed.schema if f.name != time])
    if seed is not None:
        micros = F.unix_micros(F.max(time)).alias("seed_micros")
        seed = seed.groupBy(*keys).agg(micros).groupBy(*keys)
    processor = CooldownProcessor(
        round(minutes * 60_000_000), tie, kept_schema.names, expire=delay is not None
    )
    kept = timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=kept_schema,
        outputMode="append",
        timeMode="none" if delay is None else "eventTime",
        initialState=seed,
    )
    return kept.withColumn(time, F.timestamp_micros("at_micros")).select(columns)


def start_cooldown(
    candidates: DataFrame,
    path: str,
    state_path: str,
    checkpoint: str,
    *,
    keys: Sequence[str] = ("location", "alert_type"),
    time: str = "event_time",
    tie: str = "event_id",
    minutes: float = 30,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the alerts of each micro-batch with the batch operator.

    Micro-batch n writes its alerts to ``batch=n`` and the latest kept time of every key so far
    to ``batch=n`` of the state table, which seeds micro-batch n+1. A micro-batch that runs
    again starts from the same seed and replaces both.
    """
    keys = list(keys)
    state_schema = T.StructType([candidates.schema[c] for c in [*keys, time]])

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seed = read_or_empty(spark, f"{state_path}/batch={batch_id - 1}", state_schema)
        kept = cooldown(batch, keys=keys, time=time, tie=tie, minutes=minutes, seed=seed)
        folder = f"{path}/batch={batch_id}"
        kept.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(batch.schema).parquet(folder).select(*keys, time)
        latest = seed.unionByName(written).groupBy(*keys).agg(F.max(time).alias(time))
        latest.write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")

    return (
        candidates.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
