"""CSV drop files.

Columns are found by the names in the header of each file: their order does not matter, further
columns are left out, and a column that is not there is null in all rows of the file. Files are
read in groups of one header, so that each group is one plain CSV scan. Headers come from the first
block of each file, and from an index of the files seen before, if there is one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import REQUIRED_FIELDS
from ..schemas import CORRUPT
from ..session import empty_frame, read_or_empty

FILES = "*.csv"
# A quoted "" stays blank text and an empty cell is null; both count as missing later on.
_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',  # a quote inside quotes is doubled
    "enforceSchema": "true",
    "nullValue": "\u0001",
    "emptyValue": "",
    "columnNameOfCorruptRecord": CORRUPT,
}
DROPS_DDL = ", ".join(f"{c} string" for c in (*REQUIRED_FIELDS.values(), CORRUPT, "file_name"))


HEADERS_DDL = "path string, header string"
HEAD_BYTES = 1 << 16
_LISTING_DDL = "path string, modificationTime timestamp, length bigint, content binary"


def _files(reader, path: str | list[str]) -> DataFrame:
    """The path of every drop file; contents are not read."""
    files = reader.format("binaryFile").schema(_LISTING_DDL).option("pathGlobFilter", FILES)
    return files.load(path).select("path")


def _first_line(path: str) -> str | None:
    """The first line that is not blank, from as many blocks as it takes; null if there is none."""
    if path.startswith("file:"):
        files, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        files, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    head = b""
    with files.open_input_file(name) as source:
        while True:
            block = source.read(HEAD_BYTES)
            head = (head + block).removeprefix(b"\xef\xbb\xbf").lstrip(b" \t\r\n")
            line, *rest = re.split(rb"[\r\n]", head, maxsplit=1)
            if rest or not block:
                return line.decode("utf-8", "replace") or None


def _read_heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = re.compile(rf'(^|,)\s*"?({"|".join(REQUIRED_FIELDS)})"?\s*(,|$)')
    for batch in batches:
        lines = [_first_line(path) for path in batch.column("path").to_pylist()]
        found = pa.array([x if x and names.search(x) else None for x in lines], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("path"), found], names=["path", "header"])


def headers(files: DataFrame, index: str | None = None) -> list[Row]:
    """header and paths, one row per distinct header of the files.

    The header is the first line, if it has one of the field names as a cell; a file without such
    a line has no header, and none of its columns is known. ``index`` names a table of the headers
    of files seen before: only files that are not in it are opened, and they are appended. The
    paths come to the driver since a scan is made of them; it holds as many in its own listing.
    """
    if index is None:
        found = files.mapInArrow(_read_heads, HEADERS_DDL)
    else:
        spark = files.sparkSession
        known = read_or_empty(spark, index, HEADERS_DDL)
        new_files(files, known, "path").mapInArrow(_read_heads, HEADERS_DDL).write.mode(
            "append"
        ).parquet(index)
        # Files that two runs appended at a time are there twice.
        known = spark.read.schema(HEADERS_DDL).parquet(index).dropDuplicates(["path"])
        found = files.join(known, "path")
    return found.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()


def _columns(spark: SparkSession, header: str | None) -> list[str]:
    """The cells of a header line, as Spark's own parser reads them."""
    if header is None:
        return []
    width = header.count(",") + 1
    cells = ", ".join(f"c{n} string" for n in range(width))
    options = {k: _OPTIONS[k] for k in ("escape", "nullValue", "emptyValue")}
    line = spark.range(1).select(F.from_csv(F.lit(header), cells, options).alias("c"))
    return [(name or "").strip().lstrip("﻿") for name in line.first().c if name is not None]


def _read_group(
    spark: SparkSession, paths: list[str], header: str | None, multi_line: bool
) -> DataFrame:
    cells = _columns(spark, header)
    schema = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(cells) or 1)])
    schema = schema.add(CORRUPT, T.StringType())
    rows = (
        spark.read.schema(schema)
        .options(**_OPTIONS, multiLine=str(multi_line).lower())
        .csv(sorted(paths))
    )
    nothing = F.lit(None).cast("string")
    chosen = [
        (F.col(f"c{cells.index(name)}") if name in cells else nothing).alias(column)
        for name, column in REQUIRED_FIELDS.items()
    ]
    # Without a known column there is nothing that a broken line could hide.
    corrupt = F.col(CORRUPT) if any(n in cells for n in REQUIRED_FIELDS) else nothing.alias(CORRUPT)
    return rows.select(*chosen, corrupt, F.col("_metadata.file_name").alias("file_name"))


def read_files(spark: SparkSession, groups: list[Row], multi_line: bool = False) -> DataFrame:
    """The rows of files in groups of one header."""
    result = None
    for group in sorted(groups, key=lambda g: (g.header is None, g.header)):
        rows = _read_group(spark, group.paths, group.header, multi_line)
        result = rows if result is None else result.unionByName(rows)
    return empty_frame(spark, DROPS_DDL) if result is None else result


def read_drops(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, index: str | None = None
) -> DataFrame:
    """All drop files of a folder: text columns, the broken line if any, and the file name.

    ``multi_line`` allows line breaks in quoted cells; a file is then read by one task. ``index``
    names the table that remembers headers from one read to the next.
    """
    return read_files(spark, headers(_files(spark.read, path), index), multi_line)


def stream_drops(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The paths of new drop files as a stream; ``read_files(spark, headers(batch))`` gives the
    rows of a micro-batch. A file counts as the same wherever its base name is, and is never
    divided among micro-batches."""
    reader = spark.readStream.option("fileNameOnly", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _files(reader, path)


def write_drops(readings: DataFrame, path: str) -> None:
    """Text readings as drop files with a header and the wire names."""
    (
        readings.select(*[F.col(c).alias(name) for name, c in REQUIRED_FIELDS.items()])
        .write.mode("append")
        .option("header", "true")
        .option("emptyValue", '""')
        .option("escape", '"')
        .csv(path)
    )


def new_files(listing: DataFrame, processed: DataFrame, name: str = "file_name") -> DataFrame:
    """Files of a listing that were not processed yet."""
    return listing.join(processed.select(name), name, "left_anti")
