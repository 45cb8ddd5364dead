"""Tables behind JDBC, as options for Spark's own reader and writer.

The driver of the database has to be on the class path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    options: dict[str, str] = field(default_factory=dict)

    def read_options(
        self,
        split_by: str | None = None,
        lower: str | None = None,
        upper: str | None = None,
        splits: int | None = None,
    ) -> dict[str, str]:
        """Options of a read, split into ranges of ``split_by`` so that tasks share the table."""
        found = {"url": self.url, "dbtable": self.table, "fetchsize": "10000", **self.options}
        if split_by is not None:
            found |= {
                "partitionColumn": split_by,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(splits),
            }
        return found

    def read(self, spark: SparkSession, **split) -> DataFrame:
        """The table; filters, columns, order and limit set on it later reach the database."""
        return spark.read.format("jdbc").options(**self.read_options(**split)).load()

    def append(self, rows: DataFrame, connections: int = 16) -> None:
        """Append with one connection per task and at most ``connections`` at a time."""
        (
            rows.write.format("jdbc")
            .options(url=self.url, dbtable=self.table, numPartitions=str(connections), **self.options)
            .mode("append")
            .save()
        )
