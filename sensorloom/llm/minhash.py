"""Near-duplicates by one-permutation hashing with optimal densification.

A document's shingle hashes are dealt into bins by one hash; the least value of each bin is its
signature, and an empty bin borrows from a bin that a fixed random sequence of bins leads to. Bands
of the signature are the bucket keys. In each bucket only star-shaped edges are proposed, from one
centre to the other members; each is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct, mix64, slices, stored
from .components import components
from .hashing import text_bytes, word_hashes

SHINGLE = 5
THRESHOLD = 85  # percent
# A pair at similarity s shares no band with probability (1 - s**5)**25: 4e-7 at 0.85, 5e-5 at 0.8,
# which is the least that bands of this size are made for.
LEAST_THRESHOLD = 80
ROWS_PER_BAND = 5
BANDS = 25
BINS = ROWS_PER_BAND * BANDS
# The exact second round compares blocks of so many sets with chunks of so many others.
BLOCK = 64
CHUNK = 1024

_WORD_WEIGHTS = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
_EDGES = np.array([-(-(b << 64) // BINS) for b in range(BINS)], dtype=np.uint64)
_BAND_SALT = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))

SIGNATURES_DDL = "doc_id long, n long, h1 long, h2 long, keys array<long>"
SETS_DDL = "doc_id long, shingles binary"


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    data, borders = text_bytes(texts)
    hashes, _, _, first = word_hashes(data, borders)
    windows = np.zeros(max(0, len(hashes) - SHINGLE + 1), dtype=np.uint64)
    for n, weight in enumerate(_WORD_WEIGHTS):
        windows += hashes[n : n + len(windows)] * weight
    windows = mix64(windows)
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - start >= SHINGLE:
            yield distinct(windows[start : stop - SHINGLE + 1])
        elif stop > start:
            whole = hashes[start:stop] * _WORD_WEIGHTS[: stop - start]
            yield mix64(np.array([np.sum(whole, dtype=np.uint64) + np.uint64(stop - start)]))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _probes(attempt: int) -> np.ndarray:
    """The bin that each empty bin looks at in its n-th attempt."""
    bins = np.arange(BINS, dtype=np.uint64)
    seeds = mix64(bins + np.uint64(attempt * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (seeds % np.uint64(BINS)).astype(np.int64)


_PROBES = [_probes(n) for n in range(1, 65)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """One value per bin: its least shingle hash, or what optimal densification borrows."""
    at = np.searchsorted(shingles, _EDGES)
    ends = np.append(at[1:], len(shingles))
    filled = at < ends
    least = shingles[np.minimum(at, len(shingles) - 1)]
    if filled.all():
        return least
    if filled.sum() == 1:
        return np.full(BINS, shingles[0])
    source = np.arange(BINS)
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        attempt += 1
        probes = _PROBES[attempt - 1] if attempt <= len(_PROBES) else _probes(attempt)
        target = probes[empty]
        found = filled[target]
        source[empty[found]] = target[found]
        empty = empty[~found]
    return least[source]


def band_keys(values: np.ndarray) -> np.ndarray:
    parts = values.reshape(BANDS, ROWS_PER_BAND)
    key = _BAND_SALT.copy()
    for n in range(ROWS_PER_BAND):
        key = mix64(key ^ parts[:, n]) + np.uint64(n)
    return key


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, set size, a 128-bit digest of the shingle set, and the keys of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, ones, twos, keys = [], [], [], []
                for shingles in shingle_sets(part.column(1)):
                    sizes.append(len(shingles))
                    ones.append(np.sum(mix64(shingles), dtype=np.uint64))
                    twos.append(np.sum(mix64(~shingles), dtype=np.uint64))
                    keys.append(
                        band_keys(signature(shingles)).view(np.int64) if len(shingles) else []
                    )
                signed = [np.array(h, dtype=np.uint64).view(np.int64) for h in (ones, twos)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        *map(pa.array, signed),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "h1", "h2", "keys"],
                )

    return docs.mapInArrow(run, SIGNATURES_DDL)


def full_sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [s.tobytes() for s in shingle_sets(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"]
                )

    return docs.mapInArrow(run, SETS_DDL)


def confirm(edges: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Edges (a, b) whose full sets reach the threshold in percent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3)):
                one = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                two = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                common = len(one) + len(two) - len(np.union1d(one, two))
                good.append(100 * common >= threshold * (len(one) + len(two) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two"))
    pairs = edges.join(left, "a").join(right, "b").select("a", "b", "one", "two")
    return pairs.mapInArrow(run, "a long, b long").distinct()


def confirm_blocks(centres: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between centres (key, block, chunk, id, component, shingles) and members of
    other components in the same group. A member gives one link for each component it reaches."""

    def run(group: pa.Table) -> pa.Table:
        left = group.filter(pc.field("centre"))
        right = group.filter(~pc.field("centre"))
        found: set[tuple[int, int]] = set()
        sets = [np.frombuffer(b, dtype=np.uint64) for b in left["shingles"].to_pylist()]
        ids, owners = left["id"].to_pylist(), np.array(left["component"].to_pylist())
        sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        values, column = np.unique(every, return_inverse=True)
        held = np.zeros((len(values) + 1, len(sets)), dtype=np.uint8)
        held[column, np.repeat(np.arange(len(sets)), sizes)] = 1
        for other, owner, blob in zip(
            right["id"].to_pylist(), right["component"].to_pylist(), right["shingles"].to_pylist()
        ):
            own = np.frombuffer(blob, dtype=np.uint64)
            at = np.searchsorted(values, own)
            at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] != own)] = len(values)
            common = held[at].sum(axis=0, dtype=np.int64)
            good = 100 * common >= threshold * (sizes + len(own) - common)
            reached: set[int] = {owner}
            for n in np.flatnonzero(good).tolist():
                if owners[n] not in reached:
                    reached.add(int(owners[n]))
                    found.add((min(ids[n], other), max(ids[n], other)))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = centres.withColumn("centre", F.lit(True)).unionByName(
        members.withColumn("centre", F.lit(False))
    )
    return rows.groupBy("key", "block", "chunk").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents link at a Jaccard similarity of ``threshold`` percent (80 to 100) or more of their
    sets of five-word shingles; component_id is the least id that links lead to, and the document with
    that id is kept.

    Documents with equal sets are one node from the start (partial aggregation, so thousands of
    copies never meet in one task). Band keys held by two nodes or more become buckets. The centre
    of a bucket is its member with the most bucket neighbours; pairs are (centre, member), so a
    bucket of m members costs m - 1 of them. Where members of a bucket are in different components
    afterwards, those outside its largest component are compared with all others in blocks, so
    no link that joins components is lost and nothing is capped.

    Null and empty texts and texts of white space have no set and stay alone; a null id has a null
    component and is kept; equal rows link; other columns are ignored; an empty table gives no
    rows.
    """
    if not LEAST_THRESHOLD <= threshold <= 100:
        raise ValueError(f"the threshold must lie between {LEAST_THRESHOLD} and 100 percent")
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    all_sets = stored(signatures(docs), "signatures")
    linked = all_sets.where("n > 0 and doc_id is not null")
    nodes = linked.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "n", "keys")).alias("first"))
    entries = nodes.select(
        F.col("first.doc_id").alias("id"),
        F.col("first.n").alias("n"),
        F.explode("first.keys").alias("key"),
    )
    entries = stored(entries, "entries")
    labels = components(_links(docs, _buckets(entries), threshold))
    groups = linked.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    groups = groups.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "h1", "h2", F.coalesce("component", "node").alias("component_id")
    )
    alone = all_sets.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return (
        linked.join(groups, ["h1", "h2"])
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _buckets(entries: DataFrame) -> DataFrame:
    """key, id, n of the keys that two nodes or more hold; of keys with the same members one."""
    sizes = entries.groupBy("key").agg(
        F.count("*").alias("size"),
        F.sum(F.xxhash64("id") % (1 << 50)).alias("digest"),
        F.min("id").alias("least"),
    )
    chosen = (
        sizes.where("size > 1")
        .groupBy("size", "digest", "least")
        .agg(F.min("key").alias("key"), F.count("*").alias("bands"))
        .select("key", "size", "bands")
    )
    return stored(entries.join(chosen, "key"), "buckets")


def _links(docs: DataFrame, buckets: DataFrame, threshold: int) -> DataFrame:
    degree = buckets.groupBy("id").agg(F.sum(F.expr("size * bands")).alias("degree"))
    degree = stored(degree, "degree")
    ids = degree.select(F.col("id").alias("doc_id"))
    near = docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = stored(full_sets(near), "sets")

    ranked = buckets.join(degree, "id").select("key", "id", "n", "degree")
    centre = ranked.groupBy("key").agg(
        F.max(F.struct("degree", F.negative("id").alias("id"), "n")).alias("top")
    )
    centre = centre.select(
        "key", F.negative("top.id").alias("centre"), F.col("top.n").alias("centre_n")
    )
    star = stored(ranked.join(centre, "key").where("id != centre"), "star")
    fits = 100 * F.least("n", "centre_n") >= threshold * F.greatest("n", "centre_n")
    edges = star.where(fits).select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")
    )
    links = stored(confirm(edges.distinct(), sets, threshold), "links")

    # What the centres left apart: every pair across components, outside the largest one.
    rest = star.join(components(links), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    counts = rest.groupBy("key", "component").agg(F.count("*").alias("members"))
    counts = counts.groupBy("key").agg(
        F.max(F.struct("members", "component")).alias("largest"),
        F.sum("members").alias("members"),
    )
    counts = counts.where("members > largest.members").select(
        "key",
        F.col("largest.component").alias("largest"),
        F.expr(f"cast(ceil((members - largest.members) / {BLOCK}) as int)").alias("blocks"),
        F.expr(f"cast(ceil(members / {CHUNK}) as int)").alias("chunks"),
    )
    rest = stored(rest.join(counts, "key"), "rest")
    with_sets = rest.join(sets.withColumnRenamed("doc_id", "id"), "id")
    columns = ["key", "block", "chunk", "id", "component", "shingles"]
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    centres = (
        with_sets.where("component != largest")
        .withColumn("block", own.cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(*columns)
    )
    members = (
        with_sets.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*columns)
    )
    return links.unionByName(stored(confirm_blocks(centres, members, threshold), "links"))
