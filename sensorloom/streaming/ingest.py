"""Drop files to topics: check, route, place."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import TOPIC_ERRORS, TOPIC_PARTITIONS, TOPIC_READINGS
from ..functions.parse import event_time_lenient
from ..operators.routing import allocate_new, to_error_records, to_reading_records
from ..operators.validate import counts_of, judged_readings, rejected_of, valid_of
from ..session import read_or_empty
from ..sources.drops import headers, read_files
from .observed import MetricLog


PRODUCER = "ingest"


def _counts() -> list[Column]:
    valid = F.col("error_type").isNull()
    return [F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_invalid")]


class RegionTable:
    """The location dimension, whole after each batch, so that one folder is read and not all."""

    schema = "location string, partition int"

    def __init__(self, path: str):
        self.path = path

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What was known before a batch; a replayed batch does not see its own rows."""
        stored = read_or_empty(spark, f"{self.path}/upto={batch_id - 1}", self.schema)
        return stored.select("location", "partition")

    def start_with(self, regions: DataFrame) -> None:
        """Store a given dimension as the state before the first batch."""
        regions.select("location", "partition").write.mode("overwrite").parquet(f"{self.path}/upto=-1")

    def extend(self, valid: DataFrame, batch_id: int, partitions: int) -> DataFrame:
        """Give new locations their partition, store them, and return the whole dimension."""
        spark = valid.sparkSession
        known = self.before(spark, batch_id)
        grown = known.unionByName(allocate_new(valid, known, partitions))
        grown.write.mode("overwrite").parquet(f"{self.path}/upto={batch_id}")
        return self.before(spark, batch_id + 1)


def start_ingest(
    drops: DataFrame,
    topics,
    regions: RegionTable,
    checkpoint: str,
    counts_path: str | None = None,
    partitions: int = TOPIC_PARTITIONS,
    metrics: MetricLog | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream that routes drop files.

    ``drops`` comes from ``stream_drops``. The files of a micro-batch are read by their headers and
    judged once; the judged rows are kept while the outputs are written, on executor disks where
    memory is short, so ``files_per_trigger`` bounds them. Every output is addressed by the batch
    number, so a batch that is run again does not write twice. ``metrics`` takes the numbers of
    valid and invalid rows, observed while the rejected ones are written.
    """

    def route(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        rows = read_files(spark, headers(files))
        judged = judged_readings(rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            timed = valid_of(judged).withColumn("event_time", event_time_lenient("date_time"))
            known = regions.extend(timed, batch_id, partitions)
            topics.write(to_reading_records(timed, known), TOPIC_READINGS, batch_id, PRODUCER)
            found = Observation(f"ingest-{batch_id}")
            observed = judged.observe(found, *_counts())
            rejected = to_error_records(rejected_of(observed))
            written = topics.write(rejected, TOPIC_ERRORS, batch_id, PRODUCER)
            if metrics is not None:
                # A batch that was published by a run before this one is not read for its errors.
                counts = found.get if written else judged.agg(*_counts()).first().asDict()
                metrics.save(spark, batch_id, **counts)
            if counts_path is not None:
                counts_of(judged).write.mode("overwrite").parquet(f"{counts_path}/batch={batch_id}")
        finally:
            judged.unpersist()

    return (
        drops.writeStream.queryName("ingest")
        .foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
