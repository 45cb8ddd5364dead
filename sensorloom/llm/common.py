"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import work_dir

ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACES = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(-1))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared work folder and read it back: what follows depends on files
    that every executor can read again, not on the lineage before them."""
    return stored_at(frame, work_dir(frame.sparkSession, name))


def stored_at(frame: DataFrame, path: str) -> DataFrame:
    """The same in a folder of the caller's, of which the content is replaced."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: int = 1, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes, one row at least.

    Bounds what vectorised code holds per text byte, however long the texts of a batch are.
    """
    sizes = batch.column(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(sizes), 0), dtype=np.int64)
    start, held = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > start and held + length > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the first column, cut so that no group of equal values is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        if held and held[-1].column(0)[0].as_py() == int(keys[-1]):
            held.append(batch)  # still the group that is held
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        if held or cut:
            parts = [*held, batch.slice(0, cut)] if cut else held
            yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def words(text: str) -> list[str]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    return [w for w in _split(text.translate(ASCII_LOWER)) if w]


def _split(text: str) -> list[str]:
    for space in "\t\n\x0b\x0c\r":
        if space in text:
            text = text.replace(space, " ")
    return text.split(" ")


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, ascending."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves about half of the output bits."""
    shifted = x >> np.uint64(30)
    shifted ^= x
    shifted *= np.uint64(0xBF58476D1CE4E5B9)
    x = shifted >> np.uint64(27)
    x ^= shifted
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=shifted)
    x ^= shifted
    return x
