"""Topics: Kafka where a broker is there, else a folder of Parquet files with the same columns.

A stored topic lies under ``<root>/<topic>/producer=<name>/batch=<n>/``. A batch is staged apart and
takes that place in one step, and a batch that has its place is not written again: consumers see
nothing of a batch whose producer was lost before that step, and nothing new when the producer
replays it. Producers of one topic do not touch each other's batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TOPIC_RECORD
from .publish import exists, publish

EARLIEST = "earliest"
LATEST = "latest"

_STORED = T.StructType(
    TOPIC_RECORD.fields
    + [T.StructField("producer", T.StringType()), T.StructField("batch", T.LongType())]
)
POSITION = ("topic", "producer", "batch", "offset")
KAFKA_POSITION = ("topic", "partition", "offset")


def position_of(records: DataFrame) -> tuple[str, ...]:
    """The columns that tell the records of a topic apart, for either kind of topic."""
    return POSITION if set(POSITION) <= set(records.columns) else KAFKA_POSITION


@dataclass(frozen=True)
class KafkaTopics:
    """Options for Spark's Kafka source and sink (needs the connector on the class path)."""

    servers: str
    options: dict[str, str] = field(default_factory=dict)

    def source_options(
        self, topic: str, starting: str = LATEST, max_offsets: int | None = None
    ) -> dict[str, str]:
        found = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": topic,
            "startingOffsets": starting,
            **self.options,
        }
        if max_offsets is not None:
            found["maxOffsetsPerTrigger"] = str(max_offsets)
        return found

    def sink_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **self.options}

    def stream(
        self,
        spark: SparkSession,
        topic: str,
        starting: str = LATEST,
        max_offsets: int | None = None,
    ) -> DataFrame:
        options = self.source_options(topic, starting, max_offsets)
        return _as_text(spark.readStream.format("kafka").options(**options).load())

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        options = self.source_options(topic, EARLIEST, None)
        return _as_text(spark.read.format("kafka").options(**options).load())

    def write(self, records: DataFrame, topic: str, batch_id: int, producer: str) -> bool:
        rows = records.select("key", "value", F.lit(topic).alias("topic"), "partition")
        rows.write.format("kafka").options(**self.sink_options()).save()
        return True


def _as_text(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


@dataclass(frozen=True)
class StoredTopics:
    """Topics in a folder that all executors share."""

    root: str
    partitions: int = 10

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def write(self, records: DataFrame, topic: str, batch_id: int, producer: str) -> bool:
        """Write the records of one topic as one batch; False if that batch is there already.

        A producer that is lost on the way writes the batch again; whatever it staged before is
        replaced, and no consumer has seen it.
        """
        if exists(records.sparkSession, self._place(topic, batch_id, producer)):
            return False
        self.stage(records, topic, batch_id, producer)
        return self.publish(records.sparkSession, topic, batch_id, producer)

    def stage(self, records: DataFrame, topic: str, batch_id: int, producer: str) -> None:
        """Write a batch where no reader looks.

        Records without a partition get one from their key. Offsets grow within a batch, and only
        one attempt at a batch is published, so (producer, batch, offset) is the position of a
        record for good.
        """
        by_key = F.pmod(F.xxhash64("key"), F.lit(self.partitions)).cast("int")
        placed = records.select(
            "key",
            "value",
            F.lit(topic).alias("topic"),
            F.coalesce("partition", by_key).alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        placed.write.mode("overwrite").parquet(self._staged(topic, batch_id, producer))

    def publish(self, spark: SparkSession, topic: str, batch_id: int, producer: str) -> bool:
        """Show a staged batch to the readers; False if an earlier attempt did."""
        return publish(
            spark, self._staged(topic, batch_id, producer), self._place(topic, batch_id, producer)
        )

    def _place(self, topic: str, batch_id: int, producer: str) -> str:
        return f"{self.path(topic)}/producer={producer}/batch={batch_id}"

    def _staged(self, topic: str, batch_id: int, producer: str) -> str:
        return f"{self.root}/_staged/{topic}/producer={producer}/batch={batch_id}"

    def read(self, spark: SparkSession, topic: str, from_batch: int = 0) -> DataFrame:
        """The records of a topic from a start position on; folders before it are not read."""
        frame = spark.read.schema(_STORED).parquet(self.path(topic))
        return frame.where(F.col("batch") >= from_batch)

    def stream(
        self,
        spark: SparkSession,
        topic: str,
        from_batch: int = 0,
        max_files: int | None = None,
    ) -> DataFrame:
        reader = spark.readStream.schema(_STORED)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path(topic)).where(F.col("batch") >= from_batch)
