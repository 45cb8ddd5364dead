"""Removal of lines that many documents share, by a sharded minimal perfect hash.

Distinct line hashes of 128 bits are counted by documents. Those that more than one document holds
go to shards; each shard becomes a minimal perfect hash that indexes a compact array of fingerprints
and one of counts. Documents look their lines up in these arrays, and no line is joined.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .perfecthash import PerfectHash, build, unpack

MIN_DOCS = 10
MIN_CHARS = 1
SLICE_BYTES = 1 << 20
# Counts of so many different lines are held by a task before it passes them on.
HELD_LINES = 1 << 17
SHARD_LINES = 1 << 16
# The shards that every task holds have at most so many lines, about 13 bytes each.
RESIDENT_LINES = 1 << 20

_COUNTS_DDL = "high long, low long, n long"
_SHARDS_DDL = "shard long, levels binary, bits binary, fingerprints binary, counts binary"
_PROBES_DDL = "shard long, text_key binary, keys binary"
_FOUND_DDL = "text_key binary, found binary"
_KEPT_DDL = "doc_id long, n_lines long, n_dropped long, kept string"


@dataclass
class LineIndex:
    """Shards that every task holds (lines of ``resident_from`` documents or more), and stored
    shards of the lines between the threshold and that, if there are any."""

    resident: Broadcast
    shards: int
    resident_from: int
    min_docs: int
    min_chars: int
    routed: DataFrame | None = None
    routed_shards: int = 0


def line_keys(text: bytes, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the hash of each one's key (None for a key that is too short)."""
    lines = text.split(b"\n")
    # bytes.strip and bytes.lower know just the six ASCII blanks and A-Z.
    keys = [line.strip().lower() for line in lines]
    long_enough = [len(k) >= min_chars and (min_chars < 2 or _chars(k) >= min_chars) for k in keys]
    return lines, [
        xxhash.xxh3_128_digest(k) if ok else None for k, ok in zip(keys, long_enough)
    ]


def _chars(key: bytes) -> int:
    return len(key.decode())


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, column, SLICE_BYTES):
            yield part, [t.encode() for t in pc.fill_null(part.column(column), "").to_pylist()]


def _halves(keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(keys, dtype="<u8").reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def count_lines(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """high and low (the hash of a line's key) and n, the number of rows of ``docs`` that hold it.

    Counts are summed in each task first, so a line that a third of all documents hold is a few
    rows of the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for _, texts in _texts(batches, 0):
            for text in texts:
                held.update({k for k in line_keys(text, min_chars)[1] if k is not None})
            if len(held) >= HELD_LINES:
                yield _counted(held)
                held = Counter()
        if held:
            yield _counted(held)

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(run, _COUNTS_DDL).groupBy("high", "low")
    return counts.agg(F.sum("n").alias("n"))


def _counted(held: Counter[bytes]) -> pa.RecordBatch:
    high, low = _halves(b"".join(held))
    n = np.fromiter(held.values(), dtype=np.int64, count=len(held))
    return pa.RecordBatch.from_arrays(
        [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n)],
        names=["high", "low", "n"],
    )


def index_lines(
    docs: DataFrame,
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    resident_lines: int = RESIDENT_LINES,
) -> LineIndex:
    """The index of the lines of ``docs`` that can reach ``min_docs``.

    All lines of two documents or more are in the shards that go to every task, as long as these
    have at most ``resident_lines`` lines; beyond that, only the commonest lines are, down to a
    number of documents taken from the measured counts. Lines below it that still reach
    ``min_docs`` are in shards that stay in storage.
    """
    spark = docs.sparkSession
    counts = count_lines(docs, text_col, min_chars).where(F.col("n") >= min(2, min_docs))
    counts = stored(counts, "line_counts")
    # A few hundred classes of counts, whatever the corpus.
    classes = (
        counts.groupBy(F.floor(F.log2("n") * 16).alias("size"))
        .agg(F.min("n").alias("least"), F.count("*").alias("lines"))
        .orderBy(F.desc("size"))
        .collect()
    )
    resident_from, lines = 1 << 62, 0
    for row in classes:
        if lines + row.lines > resident_lines:
            break
        resident_from, lines = row.least, lines + row.lines
    shards = -(-lines // SHARD_LINES)
    own = _sharded(counts.where(F.col("n") >= resident_from), shards).collect() if shards else []
    packed = {r.shard: (r.levels, r.bits, r.fingerprints, r.counts) for r in own}
    resident = spark.sparkContext.broadcast((uuid.uuid4().hex, packed))
    index = LineIndex(resident, shards, resident_from, min_docs, min_chars)
    rest = sum(row.lines for row in classes if row.least < resident_from)
    if rest and resident_from > min_docs:
        low = counts.where((F.col("n") < resident_from) & (F.col("n") >= min_docs))
        index.routed_shards = -(-rest // SHARD_LINES)
        index.routed = stored(_sharded(low, index.routed_shards), "line_shards")
    return index


def _sharded(counts: DataFrame, shards: int) -> DataFrame:
    return counts.groupBy(_shard(F.col("high"), shards).alias("shard")).applyInArrow(
        _build_shard, _SHARDS_DDL
    )


def _shard(high: Column, shards: int) -> Column:
    return F.pmod(high, F.lit(shards)).cast("long")


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    high, low = (rows.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
    packed = build(high, low, rows.column("n").to_numpy()).pack()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64())} | {
        name: pa.array([value], pa.binary()) for name, value in packed.items()
    })


_unpacked: dict[str, dict[int, PerfectHash]] = {}


def _resident(index: Broadcast) -> dict[int, PerfectHash]:
    """The arrays of a broadcast, unpacked once per worker."""
    name, packed = index.value
    if name not in _unpacked:
        _unpacked.clear()
        _unpacked[name] = {n: unpack(*parts) for n, parts in packed.items()}
    return _unpacked[name]


def look_up(shards: dict[int, PerfectHash], n_shards: int, keys: list[bytes]) -> np.ndarray:
    """The number of documents of each key, 0 where the shards do not have it."""
    found = np.zeros(len(keys), dtype=np.int64)
    if not keys or not n_shards:
        return found
    high, low = _halves(b"".join(keys))
    shard = high.view(np.int64) % n_shards
    order = np.argsort(shard, kind="stable")
    borders = np.searchsorted(shard[order], np.arange(n_shards + 1))
    for n, arrays in shards.items():
        rows = order[borders[n] : borders[n + 1]]
        if len(rows):
            found[rows] = arrays.find(high[rows], low[rows])
    return found


def without_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    resident_lines: int = RESIDENT_LINES,
) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and kept (the text without dropped lines).

    Texts are split at ``\\n``. The key of a line is the line without blanks (space and \\x09 to
    \\x0D) at its ends, with A-Z lower-cased. A key of at least ``min_chars`` code points that at
    least ``min_docs`` documents hold loses all its lines, in every document; the others stay as
    they are, joined by ``\\n``.

    Every row of ``docs`` is a document and gives one row, also rows that are equal or share an
    id, and rows without an id. A null or empty text is one empty line; a text that loses all
    lines is empty; other columns are ignored; an empty table gives no rows.

    Documents are read twice and not shuffled while the lines that reach ``min_docs`` fit the
    resident shards. Beyond that, hashes of lines that are not resident go to the shards of the
    others, and what they find returns to the texts.
    """
    index = index_lines(docs, text_col, min_docs, min_chars, resident_lines)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    if index.routed is None:
        return rows.mapInArrow(_dropper(index), _KEPT_DDL)
    keyed = rows.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    found = _routed_hits(keyed.select("text", "text_key"), index)
    both = keyed.join(found, "text_key", "left").select("doc_id", "text", "found")
    return both.mapInArrow(_dropper(index), _KEPT_DDL)


def _dropper(index: LineIndex) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, text) or (doc_id, text, found) to rows of the result."""
    broadcast, shards = index.resident, index.shards
    min_docs, min_chars = index.min_docs, index.min_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident = _resident(broadcast)
        for part, texts in _texts(batches, 1):
            split = [line_keys(text, min_chars) for text in texts]
            keys = list({k for _, own in split for k in own if k is not None})
            counts = look_up(resident, shards, keys)
            common = {k for k, n in zip(keys, counts.tolist()) if n >= min_docs}
            extra = part.column(2).to_pylist() if part.num_columns > 2 else [None] * len(split)
            kept, dropped = [], []
            for (lines, own), found in zip(split, extra):
                gone = common
                if found:
                    gone = common.union(k for f in found for k in _cut_keys(f))
                stay = [line for line, key in zip(lines, own) if key is None or key not in gone]
                kept.append(b"\n".join(stay))
                dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(lines) for lines, _ in split], pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept"],
            )

    return run


def _cut_keys(keys: bytes) -> list[bytes]:
    return [keys[n : n + 16] for n in range(0, len(keys), 16)]


def _routed_hits(texts: DataFrame, index: LineIndex) -> DataFrame:
    """text_key and found: the keys of a text's lines that stored shards say are common. Lines of
    the resident shards, the hot ones, never travel."""
    broadcast, shards, n_routed = index.resident, index.shards, index.routed_shards
    min_chars = index.min_chars

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident = _resident(broadcast)
        for part, texts in _texts(batches, 0):
            rows: dict[tuple[int, bytes], bytes] = {}
            for text, text_key in zip(texts, part.column(1).to_pylist()):
                keys = sorted({k for k in line_keys(text, min_chars)[1] if k is not None})
                counts = look_up(resident, shards, keys)
                keys = [k for k, n in zip(keys, counts.tolist()) if not n]
                if not keys:
                    continue
                shard = (_halves(b"".join(keys))[0].view(np.int64) % n_routed).tolist()
                own: dict[int, list[bytes]] = {}
                for key, n in zip(keys, shard):
                    own.setdefault(n, []).append(key)
                rows |= {(n, text_key): b"".join(part_keys) for n, part_keys in own.items()}
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, _ in rows], pa.int64()),
                        pa.array([key for _, key in rows], pa.binary()),
                        pa.array(list(rows.values()), pa.binary()),
                    ],
                    names=["shard", "text_key", "keys"],
                )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = None
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for row in range(batch.num_rows):
                text_key, keys, *parts = (batch.column(n)[row].as_py() for n in range(1, 7))
                if text_key is None:  # a shard comes before the keys that look into it
                    arrays = unpack(*parts)
                    continue
                hits = np.flatnonzero(arrays.find(*_halves(keys)))
                if len(hits):
                    own = _cut_keys(keys)
                    out.append((text_key, b"".join(own[i] for i in hits.tolist())))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary()) for c in zip(*out)], names=["text_key", "found"]
                )

    sent = texts.mapInArrow(send, _PROBES_DDL).dropDuplicates(["shard", "text_key"])
    met = index.routed.unionByName(sent, allowMissingColumns=True)
    met = met.select("shard", "text_key", "keys", "levels", "bits", "fingerprints", "counts")
    met = met.repartition(n_routed, "shard").sortWithinPartitions("shard", "text_key")
    hits = met.mapInArrow(probe, _FOUND_DDL)
    return hits.groupBy("text_key").agg(F.collect_list("found").alias("found"))


def contents(index: LineIndex) -> int:
    """The number of lines that the index holds, for reports and tests."""
    own = sum(len(parts[2]) // 8 for parts in index.resident.value[1].values())
    if index.routed is None:
        return own
    return own + index.routed.agg(F.sum(F.length("fingerprints") / 8).cast("long")).first()[0]
