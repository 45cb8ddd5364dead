"""The outbox: the oldest unsent rows are sent, and acknowledged only on success.

Acknowledgements are an append-only table of (id, sent_at). The current state of a table is
the table joined with its acknowledgements, so no row is rewritten while sending.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import OUTBOX_BATCH
from ..session import read_or_empty
from ..sources.publish import publish

Sender = Callable[[str], bool]


def apply_acks(rows: DataFrame, acks: DataFrame, id_column: str = "id") -> DataFrame:
    """The rows with their send state; the first acknowledgement of a row counts.

    An update by id: both sides are spread by a unique id, or the acknowledgements are
    broadcast while they are measured to be small.
    """
    first = acks.groupBy(F.col(id_column)).agg(F.min("sent_at").alias("_sent_at"))
    joined = rows.join(first, id_column, "left")
    return joined.withColumns(
        {
            "slack_sent": F.col("slack_sent") | F.col("_sent_at").isNotNull(),
            "slack_sent_at": F.coalesce("slack_sent_at", "_sent_at"),
        }
    ).select(rows.columns)


def unsent_batch(
    rows: DataFrame, id_column: str = "id", limit: int = OUTBOX_BATCH, order: str = "created_at"
) -> DataFrame:
    """The oldest unsent rows: each task keeps its own top rows, nothing is sorted whole."""
    return rows.where(~F.col("slack_sent")).orderBy(order, id_column).limit(limit)


def send_all(
    batch: DataFrame,
    sender: Sender,
    id_column: str = "id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Call ``sender`` for each row on the executors; (id, success, kept columns) per row.

    The caller has to write the result, once: computing it again sends again.

    An exception counts as a failed send, so one bad message does not stop the others.
    """

    def attempt(message: str) -> bool:
        try:
            return bool(sender(message))
        except Exception:
            return False

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sent = pd.DataFrame(
                {id_column: frame[id_column], "success": [attempt(m) for m in frame[text]]}
            )
            yield sent.assign(**{c: frame[c] for c in keep})

    narrow = batch.select(id_column, text, *keep)
    kinds = dict(narrow.dtypes)
    kept = "".join(f", {c} {kinds[c]}" for c in keep)
    return narrow.mapInPandas(run, f"{id_column} {kinds[id_column]}, success boolean{kept}")


@dataclass(frozen=True)
class Schedule:
    """When a row whose sending failed is due again: after ``base`` seconds, and after twice as long
    with every further failure, up to ``longest``. By default it is due in the next cycle."""

    base: float = 0.0
    longest: float = 6 * 3600.0

    def due_at(self, failures: Column, last: Column) -> Column:
        doubled = F.least(F.pow(F.lit(2.0), failures - 1) * self.base, F.lit(self.longest))
        return last + F.make_dt_interval(secs=doubled)


class Outbox:
    """A stored table of rows to send, and what became of them.

    Rows lie under ``rows/date=``, foldered by the day of ``order``; outcomes under ``acks/date=`` by
    the day of their row. The low-water mark is the oldest day with a row that is not sent: a
    cycle reads no folder before it, so its cost follows the backlog and not the age of the table.

    A row that fails steps back by its ``schedule``, so rows that always fail do not keep later
    ones from being sent. Several drainers may work on one outbox: a cycle's pick is published as
    one numbered turn, which only one drainer gets, and its rows are its own until their lease
    ends or their outcome is there. A long backlog is drained by runs of turns, which are picked,
    published and sent together.
    """

    def __init__(
        self,
        path: str,
        id_column: str = "id",
        order: str = "created_at",
        schedule: Schedule = Schedule(),
        lease_seconds: float = 600.0,
    ):
        self.path = path
        self.id_column = id_column
        self.order = order
        self.schedule = schedule
        self.lease_seconds = lease_seconds

    def add(self, rows: DataFrame, mode: str = "append") -> None:
        """Rows of days before the low-water mark move the mark back."""
        placed = rows.withColumn("date", F.to_date(self.order))
        placed.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(
            f"{self.path}/rows"
        )
        spark = rows.sparkSession
        mark = self.low_water(spark)
        if mark is None:
            return
        oldest = placed.agg(F.min("date")).first()[0]
        if oldest is not None and oldest < mark:
            self._set_mark(spark, oldest)

    def _stored_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def _id_type(self, spark: SparkSession) -> str:
        return self._stored_rows(spark).schema[self.id_column].dataType.simpleString()

    def _acks(self, spark: SparkSession) -> DataFrame:
        """Outcomes; a compacted one stands for ``attempts`` of them, the last at ``sent_at``."""
        schema = (
            f"{self.id_column} {self._id_type(spark)}, success boolean, sent_at timestamp, "
            "attempts long, turn long, date date"
        )
        return read_or_empty(spark, f"{self.path}/acks", schema)

    def low_water(self, spark: SparkSession):
        return self._mark(spark)[0]

    def _mark(self, spark: SparkSession) -> tuple:
        """The low-water mark, and its number."""
        marks = read_or_empty(spark, f"{self.path}/low_water", "mark date, cycle long")
        found = marks.orderBy(F.desc("cycle")).first()
        return (found.mark, found.cycle) if found else (None, -1)

    def _set_mark(self, spark: SparkSession, mark) -> None:
        """One small table, replaced whole: a new one is published, and reading takes the last."""
        cycle = self._mark(spark)[1] + 1
        staged = f"{self.path}/_staged/low_water-{uuid.uuid4().hex}"
        spark.createDataFrame([(mark,)], "mark date").coalesce(1).write.parquet(staged)
        publish(spark, staged, f"{self.path}/low_water/cycle={cycle}")

    def state(self, spark: SparkSession, since=None) -> DataFrame:
        """All rows, or those from a day on, with their send state."""
        rows, acks = self._stored_rows(spark), self._acks(spark)
        if since is not None:
            rows, acks = (f.where(F.col("date") >= F.lit(since)) for f in (rows, acks))
        done = acks.where("success").select(self.id_column, "sent_at")
        return apply_acks(rows, done, self.id_column)

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """How often each row was sent and how often sending it failed."""
        sums = {
            name: F.coalesce(F.sum(F.when(test, F.col("attempts"))), F.lit(0))
            for name, test in (("n_sent", F.col("success")), ("n_failed", ~F.col("success")))
        }
        return self._acks(spark).groupBy(self.id_column).agg(
            *[total.alias(name) for name, total in sums.items()]
        )

    def _waiting(self, spark: SparkSession, since, now: Column) -> DataFrame:
        """Rows that failed and are not due yet, and rows that another turn has claimed."""
        acks = self._acks(spark)
        if since is not None:
            acks = acks.where(F.col("date") >= F.lit(since))
        failed = acks.where("not success").groupBy(self.id_column).agg(
            F.sum("attempts").alias("_n"), F.max("sent_at").alias("_last")
        )
        failed = failed.where(self.schedule.due_at(F.col("_n"), F.col("_last")) > now)
        claims = self._claims(spark).where(F.col("lease_until") > now)
        # An outcome ends the claim of its turn, and of any turn before.
        done = acks.groupBy(self.id_column).agg(F.max("turn").alias("_done"))
        claimed = claims.join(done, self.id_column, "left").where(
            F.col("_done").isNull() | (F.col("turn") > F.col("_done"))
        )
        return failed.select(self.id_column).unionByName(claimed.select(self.id_column))

    def _claims(self, spark: SparkSession) -> DataFrame:
        """A run of turns lies in the folder of its first; ``nth`` counts its turns from there."""
        schema = (
            f"{self.id_column} {self._id_type(spark)}, date date, lease_until timestamp, nth long, turn long"
        )
        claims = read_or_empty(spark, f"{self.path}/turns", schema)
        return claims.select(
            self.id_column,
            "date",
            "lease_until",
            (F.col("turn") + F.coalesce("nth", F.lit(0))).alias("turn"),
        )

    def _run_of_turns(self, ready: DataFrame, limit: int, share: float) -> DataFrame:
        """The turns that follow each other over the oldest part of the ready rows, as ``nth``.

        Rows are sorted by range and stored, and their places follow from the sizes of the ranges,
        so no task sees them all. An id that is there several times is in one turn only, as a turn's
        outcome counts for all its copies.
        """
        spark, path = ready.sparkSession, f"{self.path}/_staged/order-{uuid.uuid4().hex}"
        (
            ready.where(~F.col("slack_sent"))
            .repartitionByRange(self.order, self.id_column)
            .sortWithinPartitions(self.order, self.id_column)
            .withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
            .write.parquet(path)
        )
        stored = spark.read.parquet(path)
        sizes = dict(stored.groupBy("_range").count().collect())
        total = sum(sizes.values())
        turns = max(1, math.ceil(total / limit * share))
        before = list(accumulate((sizes.get(r, 0) for r in range(max(sizes, default=0) + 1)), initial=0))
        place = F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("_range"))
        place = place + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))  # the low bits count a task's rows
        nth = F.call_function("div", place, F.lit(limit))
        placed = stored.withColumn("nth", nth).where(F.col("nth") < turns)
        first = F.min("nth").over(Window.partitionBy(self.id_column))
        tasks = min(turns, spark.sparkContext.defaultParallelism)
        once = placed.withColumn("_first", first).where("nth = _first")
        return once.repartition(tasks, "nth").drop("_first", "_range", "_at")

    def _claim(
        self,
        spark: SparkSession,
        since,
        render: Column,
        limit: int,
        now: Column,
        share: float | None = None,
    ) -> tuple[int, DataFrame]:
        """The number of a turn of this drainer's own, or of the first of a run, and its rows."""
        while True:
            turn = (self._claims(spark).agg(F.max("turn")).first()[0] or 0) + 1
            waiting = self._waiting(spark, since, now)
            ready = self.state(spark, since).join(waiting, self.id_column, "left_anti")
            if share is None:
                batch = unsent_batch(ready, self.id_column, limit, self.order)
                batch = batch.withColumn("nth", F.lit(0).cast("long"))
            else:
                batch = self._run_of_turns(ready, limit, share)
            staged = f"{self.path}/_staged/turn-{uuid.uuid4().hex}"
            lease = now + F.make_dt_interval(secs=F.lit(self.lease_seconds))
            picked = batch.select(
                self.id_column, "date", render.alias("text"), lease.alias("lease_until"), "nth"
            )
            picked.write.parquet(staged)
            own = spark.read.parquet(staged)
            if own.isEmpty():
                return turn, own
            # The rows were picked without what this turn holds, so the turn has to be free. A run
            # needs no more than that: whoever saw fewer turns than there are finds its first taken.
            if publish(spark, staged, f"{self.path}/turns/turn={turn}"):
                return turn, spark.read.schema(own.schema).parquet(f"{self.path}/turns/turn={turn}")

    def drain_once(
        self,
        spark: SparkSession,
        render: Column,
        sender: Sender,
        limit: int = OUTBOX_BATCH,
        sent_at: Column | None = None,
        share: float | None = None,
    ) -> int:
        """One cycle: claim the oldest unsent rows that are due, send them, append the outcomes.

        With a ``share`` one call makes as many turns of ``limit`` rows as hold that part of the rows
        that are due (one at least), in the jobs of one: calls grow with the logarithm of the
        backlog, and the rest is left to other drainers. The lease has to outlast the whole run.

        Returns how many rows were picked. The pick is stored before anything is sent, and the
        outcomes are written in the job that sends, so no plan is computed twice with the sender in
        it. A task that is run again after a loss sends its rows again, and rows of a drainer that
        is lost are sent again when their lease ends: sending is at least once.
        """
        moment = F.current_timestamp() if sent_at is None else sent_at
        since = self.low_water(spark)
        # Also of rows that wait: the mark must not pass them.
        oldest = self.state(spark, since).where(~F.col("slack_sent")).agg(F.min("date")).first()[0]
        turn, picked = self._claim(spark, since, render, limit, moment, share)
        count = picked.count()
        if not count:
            return 0
        numbered = picked.withColumn("turn", F.col("nth") + turn)
        outcomes = send_all(numbered, sender, self.id_column, keep=("date", "turn"))
        (
            outcomes.withColumns({"sent_at": moment, "attempts": F.lit(1).cast("long")})
            .write.mode("append")
            .partitionBy("date")
            .parquet(f"{self.path}/acks")
        )
        if oldest is not None and (since is None or oldest > since):
            self._set_mark(spark, oldest)
        return count

    def compact(self, spark: SparkSession) -> None:
        """Rewrite the outcomes from the low-water mark on as few files: one row for each sent row,
        and one for the failures of each. Run it while no drainer works."""
        since = self.low_water(spark)
        acks = self._acks(spark)
        if since is not None:
            acks = acks.where(F.col("date") >= F.lit(since))
        path = f"{self.path}/compacted"
        # A sent row counts from its first success, a failed one from its last failure.
        at = F.when(F.col("success"), F.min("sent_at")).otherwise(F.max("sent_at"))
        merged = acks.groupBy(self.id_column, "date", "success").agg(
            at.alias("sent_at"), F.sum("attempts").alias("attempts"), F.max("turn").alias("turn")
        )
        merged.hint("rebalance", "date").write.mode("overwrite").parquet(path)
        (
            spark.read.parquet(path)
            .select(self.id_column, "success", "sent_at", "attempts", "turn", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(f"{self.path}/acks")
        )
