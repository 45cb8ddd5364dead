"""Compaction: the small files of a folder are packed by their sizes into files of a target size.

New rows arrive under ``fresh`` (by a stream or appended). A pass takes the files that are due, packs
those of each folder into bins, rewrites every bin as one file, and is published in one step as
``passes/pass=<n>``: its ``rows``, and in ``replaced`` the files that these stand for. Readers take
what is in ``fresh`` and in the passes, less what was replaced, so they see a pass whole or not at
all, and a pass that is lost on the way has changed nothing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import read_or_empty
from ..sources.publish import publish
from .archive import ARCHIVE_KEYS

TARGET_BYTES = 128 << 20
# A file that fills this share of the target stays as it is.
FULL = 0.75
# Bins of one pass: a bin is one task. What is left is due in the next pass.
BINS_PER_PASS = 10_000

_FILE = "path string, folder string, bytes long, modified timestamp"
_BINS = f"{_FILE}, bin int, spot int, bin_bytes long, bin_files int, oldest timestamp, made_by int"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def pack_sizes(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size: first fit, largest first. A size beyond the capacity has its own."""
    left: list[int] = []
    bins = [0] * len(sizes)
    for n in sorted(range(len(sizes)), key=lambda n: (-sizes[n], n)):
        fit = next((b for b, room in enumerate(left) if room >= sizes[n]), len(left))
        if fit == len(left):
            left.append(capacity)
        left[fit] -= sizes[n]
        bins[n] = fit
    return bins


def _plain(path: Column) -> Column:
    """A path with one slash behind its scheme."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+:)/+", "$1/")


def _decoded(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def read_path() -> Column:
    """The path of the file a row was read from, as listings have it."""
    return _plain(_decoded(F.col("_metadata.file_path")))


def listing(spark: SparkSession, path: str, many: bool = False) -> DataFrame:
    """path, folder, bytes and modified of the Parquet files below a path, which with ``many`` is a
    pattern of folders; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        files = reader.option("recursiveFileLookup", str(many).lower()).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILE)
    folder = "/".join(f"{key}=[^/]*" for key in ARCHIVE_KEYS)
    return files.select(
        _plain(F.col("path")).alias("path"),
        F.regexp_extract("path", f"({folder})/[^/]*$", 1).alias("folder"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def _key_of(folder: Column, key: str) -> Column:
    value = F.regexp_extract(folder, f"(^|/){key}=([^/]*)", 2)
    return F.when(value != _NO_VALUE, _decoded(value))


def binned(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """The bin of every small file, and what each bin holds in all. Files of a folder are few, and
    only their sizes go to the task that packs them."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("bytes", "descending"), ("path", "ascending")])
        bins = pa.array(pack_sizes(group.column("bytes").to_pylist(), target_bytes), pa.int32())
        return group.append_column("bin", bins)

    small = files.where(F.col("bytes") < FULL * target_bytes)
    packed = small.groupBy("folder").applyInArrow(pack, f"{_FILE}, bin int")
    own = Window.partitionBy("folder", "bin")
    return packed.select(
        "*",
        F.row_number().over(own.orderBy("path")).alias("spot"),
        F.sum("bytes").over(own).alias("bin_bytes"),
        F.count("*").over(own).cast("int").alias("bin_files"),
        F.min("modified").over(own).alias("oldest"),
    )


def due_bins(bins: DataFrame, least_bytes: int, now: Column, older_than: str) -> DataFrame:
    """The bins to flush: those of several files that hold ``least_bytes`` or a file that is older
    than the given interval."""
    old = F.col("oldest") <= now - F.expr(f"interval {older_than}")
    return bins.where((F.col("bin_files") > 1) & ((F.col("bin_bytes") >= least_bytes) | old))


class CompactedArchive:
    """An archive under ``path``; the stream or the writer of new rows writes to ``fresh``."""

    def __init__(self, path: str):
        self.path = path
        self.fresh = f"{path}/fresh"

    def replaced(self, spark: SparkSession) -> DataFrame:
        """Files that a pass has rewritten; they can be deleted when no reader is on them."""
        return read_or_empty(spark, f"{self.path}/passes/pass=*/replaced", _BINS).select("path")

    def files(self, spark: SparkSession) -> DataFrame:
        """The files that hold the archive's rows now."""
        passes = listing(spark, f"{self.path}/passes/pass=*/rows", many=True)
        every = listing(spark, self.fresh).unionByName(passes)
        return every.join(self.replaced(spark), "path", "left_anti")

    def compact(
        self,
        spark: SparkSession,
        target_bytes: int = TARGET_BYTES,
        least_bytes: int | None = None,
        older_than: str = "0 seconds",
    ) -> int:
        """One pass over what is due; returns the number of files it made.

        By default every bin of several files is due; ``least_bytes`` (by default the target's
        full share) with a longer ``older_than`` leaves young and small bins to wait for more.
        """
        last = self.last_pass(spark)
        number = 0 if last is None else last + 1
        staged = f"{self.path}/_staged/pass={number}"
        least = round(FULL * target_bytes) if least_bytes is None else least_bytes
        bins = binned(self.files(spark), target_bytes)
        due = due_bins(bins, least, F.current_timestamp(), older_than)
        # Bins with most files first; a limit of ordered rows is the same in every run of the plan.
        first = due.where("spot = 1").orderBy(F.desc("bin_files"), "folder", "bin")
        first = first.limit(BINS_PER_PASS).select("folder", "bin")
        due = due.join(first, ["folder", "bin"], "left_semi").withColumn("made_by", F.lit(number))
        due.write.mode("overwrite").parquet(f"{staged}/replaced")
        plan = spark.read.schema(_BINS).parquet(f"{staged}/replaced")
        most = [(r.folder, r.bin) for r in plan.where("spot = 1").select("folder", "bin").collect()]
        if not most:
            return 0
        numbers = spark.createDataFrame(
            [(*b, n) for n, b in enumerate(sorted(most))], "folder string, bin int, number int"
        )
        chosen = plan.join(F.broadcast(numbers), ["folder", "bin"]).select("path", "folder", "number")
        paths = [r.path for r in chosen.select("path").collect()]
        rows = spark.read.schema(self._data_schema(spark)).parquet(*paths)
        rows = rows.withColumn("_path", read_path())
        moved = rows.join(F.broadcast(chosen.withColumnRenamed("path", "_path")), "_path")
        keys = {key: _key_of(F.col("folder"), key) for key in ARCHIVE_KEYS}
        (
            moved.withColumns(keys)
            .repartitionById(len(most), "number")
            .drop("_path", "folder", "number")
            .write.mode("overwrite")
            .partitionBy(*ARCHIVE_KEYS)
            .parquet(f"{staged}/rows")
        )
        publish(spark, staged, f"{self.path}/passes/pass={number}")
        return len(most)

    def last_pass(self, spark: SparkSession) -> int | None:
        """The number of the last pass, None before the first."""
        found = read_or_empty(spark, f"{self.path}/passes/pass=*/replaced", _BINS)
        return found.agg(F.max("made_by")).first()[0]

    def _data_schema(self, spark: SparkSession) -> T.StructType:
        """The columns in the files: all but the folder's."""
        fields = spark.read.parquet(self.fresh).schema.fields
        return T.StructType([f for f in fields if f.name not in ARCHIVE_KEYS])

    def read(
        self,
        spark: SparkSession,
        *,
        since: str | None = None,
        until: str | None = None,
        locations: list[str] | None = None,
    ) -> DataFrame:
        """The rows of the archive, of dates from ``since`` to ``until`` (both included) and of some
        locations if given. Only files of these folders are opened."""
        folder = F.col("folder")
        live = self.files(spark)
        if since is not None:
            live = live.where(_key_of(folder, "date") >= since)
        if until is not None:
            live = live.where(_key_of(folder, "date") <= until)
        if locations is not None:
            live = live.where(_key_of(folder, "location").isin(locations))
        paths = sorted(r.path for r in live.select("path").collect())
        schema = self._data_schema(spark)
        if not paths:
            none = {key: F.lit(None).cast("string") for key in ARCHIVE_KEYS}
            return spark.createDataFrame([], schema).withColumns(none | {"date": F.lit(None).cast("date")})
        rows = spark.read.schema(schema).parquet(*paths)
        from_path = _decoded(F.col("_metadata.file_path"))
        return rows.withColumns(
            {
                "location": _key_of(from_path, "location"),
                "date": _key_of(from_path, "date").cast("date"),
            }
        )
