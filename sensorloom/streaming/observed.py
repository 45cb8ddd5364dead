"""What running streams report: metrics observed on the way, and the progress of every micro-batch.

Counts are observed on rows that a write reads anyway (``Dataset.observe``), so they cost no job.
Streams that write through a batch function keep theirs in a :class:`MetricLog`; those that write
to a sink of Spark's own report them with their progress, which :class:`ProgressLog` stores.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import read_or_empty

PROGRESS = (
    "ts timestamp, query string, run string, batch long, source int, input_rows long, "
    "start_offset string, end_offset string, latest_offset string, dropped_by_watermark long, "
    "metrics map<string, long>"
)


class MetricLog:
    """Named numbers of every micro-batch of one stream; a batch that runs again replaces its own."""

    schema = "metric string, value long"

    def __init__(self, path: str):
        self.path = path

    def save(self, spark: SparkSession, batch_id: int, **values: int) -> None:
        rows = spark.createDataFrame([Row(metric=k, value=v) for k, v in values.items()], self.schema)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """batch, metric and value."""
        return read_or_empty(spark, self.path, self.schema + ", batch long")


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every micro-batch to a table of offsets.

    One row per micro-batch and source, in the columns of ``PROGRESS``: the offsets as the source
    writes them, the rows that came in and those dropped by the watermark, and the metrics observed
    on the stream as ``name.column``. Only the named queries are logged, if ``names`` is given.
    Start it before the queries; ``close`` waits until what has ended is written.
    """

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] | None = None):
        self.spark, self.path, self.names = spark, path, names
        self.running: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        if self.names is None or event.name in self.names:
            self.running[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) in self.running and progress.numInputRows:
            rows = self.spark.createDataFrame(progress_rows(progress), PROGRESS)
            rows.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        ended = self.running.get(str(event.runId))
        if ended is not None:
            ended.set()

    def close(self, timeout: float = 60) -> None:
        for ended in list(self.running.values()):
            if not ended.wait(timeout):
                raise TimeoutError("a query that is logged has not ended")
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, PROGRESS)


def progress_rows(progress) -> list[tuple]:
    """The rows of ``PROGRESS`` for one progress report."""
    at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc)
    dropped = sum(s.numRowsDroppedByWatermark or 0 for s in progress.stateOperators)
    metrics = {
        f"{name}.{column}": int(value)
        for name, row in progress.observedMetrics.items()
        for column, value in row.asDict().items()
        if isinstance(value, int)
    }
    return [
        (
            at, progress.name, str(progress.runId), progress.batchId, n, source.numInputRows,
            source.startOffset, source.endOffset, source.latestOffset, dropped, metrics,
        )
        for n, source in enumerate(progress.sources)
    ]


def kafka_offsets(progress: DataFrame) -> DataFrame:
    """The offsets table of ``operators.metrics`` from the progress of streams over Kafka topics: one
    row per report, query (as the group), topic and partition."""
    offsets = "map<string, map<string, long>>"
    at = progress.select(
        "ts",
        F.col("query").alias("group"),
        F.from_json("end_offset", offsets).alias("committed"),
        F.from_json("latest_offset", offsets).alias("latest"),
    )
    topics = at.select("ts", "group", "latest", F.explode("committed").alias("topic", "own"))
    parts = topics.select(
        "ts", "group", "topic", "latest", F.explode("own").alias("part", "committed")
    )
    latest = F.col("latest")[F.col("topic")][F.col("part")]
    return parts.select(
        "ts",
        "group",
        "topic",
        F.col("part").cast("int").alias("partition"),
        F.coalesce(latest, F.col("committed")).alias("end_offset"),
        "committed",
    )


def counted_offsets(progress: DataFrame, topic: str, end_offset: int, metric: str) -> DataFrame:
    """The same for streams over a stored topic, where an offset is a number of records.

    ``metric`` is the observed number of records of a micro-batch, ``end_offset`` the records of the
    topic. What all micro-batches up to a report took is committed; the sum runs over the reports
    of one query, which are few.
    """
    taken = F.col("metrics")[metric]
    so_far = F.sum(taken).over(Window.partitionBy("query").orderBy("batch"))
    return progress.where("source = 0").select(
        "ts",
        F.col("query").alias("group"),
        "batch",
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(end_offset).cast("long").alias("end_offset"),
        so_far.alias("committed"),
    )
