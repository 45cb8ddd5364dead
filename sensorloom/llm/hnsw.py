"""Nearest neighbours by inner product: one navigable small-world graph per shard.

Vectors are dealt into shards of bounded size. A shard's graph has levels of geometrically fewer
nodes; each level is one flat array of neighbour numbers, a fixed number for each node. A query
descends greedily to the lowest level and searches there with a beam; the best of all shards are
merged. Many queries walk one graph at the same time, a step at a time, as array operations.

Inner products are made a distance by one more component: with it all vectors have the same norm,
so that the nearest are those with the largest inner product, whatever their own norms are. The
vectors of a shard are of similar norms, so that this component does not hide how they differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.once import once

from .common import stored

SHARD_ROWS = 8192
LINKS = 16  # per node and level; twice as many on the lowest level
CANDIDATES = 64  # nearest nodes that the links of a node are chosen from
BEAM = 128
# Powers of two that the norms of one shard span; the first band begins at a quarter.
BAND_DOUBLINGS, BAND_START = 4, -2
EXPANDED = 4  # nodes of a beam that are expanded at a time
QUERY_BLOCK = 1024

SHARDS_DDL = (
    "shard int, dimension int, ids binary, members binary, member_ends binary, vectors binary, "
    "levels array<binary>, links array<binary>"
)


@dataclass
class Graph:
    vectors: np.ndarray  # to build with the additional component in double precision, to search float32
    levels: list[np.ndarray]  # nodes of each level, lowest first
    links: list[np.ndarray]  # of each of these nodes: numbers of nodes, or -1


def _chosen(sims: np.ndarray, near: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of candidates sorted by similarity those that are nearer to the node than to any chosen
    before, then the nearest of the others until ``most`` are chosen."""
    count, width = near.shape
    points = vectors[np.maximum(near, 0)]
    between = np.einsum("bid,bjd->bij", points, points, optimize=True)
    valid = near >= 0
    kept = np.zeros((count, width), dtype=bool)
    closest = np.full((count, width), -np.inf)
    number = np.zeros(count, dtype=np.int64)
    for n in range(width):
        take = valid[:, n] & (closest[:, n] < sims[:, n]) & (number < most)
        kept[:, n] = take
        number += take
        rows = np.flatnonzero(take)
        closest[rows] = np.maximum(closest[rows], between[rows, n])
    place = np.where(kept, 0, np.where(valid, width, 2 * width)) + np.arange(width)
    order = np.argsort(place, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(near, order, axis=1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _level_links(vectors: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Links among ``nodes``: chosen from the nearest of all of them, made mutual, chosen again."""
    own = vectors[nodes]
    count, width = len(nodes), min(CANDIDATES, len(nodes) - 1)
    if width <= 0:
        return np.full((count, most), -1, dtype=np.int32)
    links = np.empty((count, most), dtype=np.int64)
    for start in range(0, count, 256):
        rows = np.arange(start, min(start + 256, count))
        sims = own[rows] @ own.T
        sims[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        sims = np.take_along_axis(sims, near, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        near, sims = np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)
        links[rows] = _chosen(sims, near, own, most)
    source = np.repeat(np.arange(count), most)
    target = links.ravel()
    here = target >= 0
    pairs = np.concatenate([source[here] * count + target[here], target[here] * count + source[here]])
    pairs = np.unique(pairs)
    source, target = pairs // count, pairs % count
    sims = np.einsum("ed,ed->e", own[source], own[target])
    order = np.lexsort((target, -sims, source))
    source, target, sims = source[order], target[order], sims[order]
    place = np.arange(len(source)) - np.searchsorted(source, source)
    within = place < 2 * CANDIDATES
    near = np.full((count, 2 * CANDIDATES), -1, dtype=np.int64)
    like = np.full(near.shape, -np.inf)
    near[source[within], place[within]] = target[within]
    like[source[within], place[within]] = sims[within]
    for start in range(0, count, 256):
        rows = np.arange(start, min(start + 256, count))
        width = max(1, int((near[rows] >= 0).sum(axis=1).max()))
        links[rows] = _chosen(like[rows, :width], near[rows, :width], own, most)
    return np.where(links >= 0, nodes[links], -1).astype(np.int32)


def build(vectors: np.ndarray) -> Graph:
    """The graph over the rows of ``vectors``, which all have the same norm."""
    random = np.random.default_rng(len(vectors))
    heights = (-np.log(random.random(len(vectors))) / np.log(LINKS)).astype(np.int64)
    levels, links = [], []
    for level in range(int(heights.max()) + 1 if len(vectors) else 0):
        nodes = np.flatnonzero(heights >= level)
        levels.append(nodes)
        links.append(_level_links(vectors, nodes, LINKS * (1 + (level == 0))))
    return Graph(vectors, levels, links)


def search(graph: Graph, queries: np.ndarray, beam: int) -> np.ndarray:
    """Up to ``beam`` nodes near each query, unordered, -1 where there are no more."""
    count, total = len(queries), len(graph.vectors)
    at = np.full(count, graph.levels[-1][0])
    like = np.einsum("qd,qd->q", queries, graph.vectors[at])
    for nodes, links in zip(graph.levels[:0:-1], graph.links[:0:-1]):
        row_of = np.full(total, -1)
        row_of[nodes] = np.arange(len(nodes))
        moving = np.arange(count)
        while len(moving):
            near = links[row_of[at[moving]]]
            sims = np.einsum("qd,qmd->qm", queries[moving], graph.vectors[np.maximum(near, 0)])
            sims[near < 0] = -np.inf
            best = np.argmax(sims, axis=1)
            top = sims[np.arange(len(moving)), best]
            better = top > like[moving]
            rows = moving[better]
            at[rows] = near[better, best[better]]
            like[rows] = top[better]
            moving = rows
    width = min(beam, total)
    found = np.full((count, width), -1)
    sims = np.full((count, width), -np.inf, dtype=np.float32)
    fresh = np.zeros((count, width), dtype=bool)  # not expanded yet
    found[:, 0], sims[:, 0], fresh[:, 0] = at, like, True
    visited = np.zeros((count, total), dtype=bool)
    visited[np.arange(count), at] = True
    links = graph.links[0]
    active = np.arange(count)
    while len(active):
        open_sims = np.where(fresh[active], sims[active], -np.inf)
        take = min(EXPANDED, width)
        best = np.argpartition(-open_sims, take - 1, axis=1)[:, :take]
        rows = np.repeat(active, take)
        slots = best.ravel()
        ready = fresh[rows, slots]
        rows, slots = rows[ready], slots[ready]
        fresh[rows, slots] = False
        near = links[found[rows, slots]]
        rows, near = np.repeat(rows, near.shape[1]), near.ravel()
        new = (near >= 0) & ~visited[rows, np.maximum(near, 0)]
        pairs = np.unique(rows[new] * total + near[new])
        rows, near = pairs // total, pairs % total
        visited[rows, near] = True
        own = np.einsum("ed,ed->e", queries[rows], graph.vectors[near])
        touched, begin, number = np.unique(rows, return_index=True, return_counts=True)
        if len(touched):
            most = int(number.max())
            cell = np.arange(len(rows)) - np.repeat(begin, number)
            line = np.repeat(np.arange(len(touched)), number)
            more = np.full((len(touched), most), -1)
            more_sims = np.full((len(touched), most), -np.inf, dtype=np.float32)
            more[line, cell], more_sims[line, cell] = near, own
            all_found = np.concatenate([found[touched], more], axis=1)
            all_sims = np.concatenate([sims[touched], more_sims], axis=1)
            all_fresh = np.concatenate([fresh[touched], more >= 0], axis=1)
            keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            found[touched] = np.take_along_axis(all_found, keep, axis=1)
            sims[touched] = np.take_along_axis(all_sims, keep, axis=1)
            fresh[touched] = np.take_along_axis(all_fresh, keep, axis=1)
        active = active[fresh[active].any(axis=1)]
    return found


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (array<double>) of vectors that take part: of the commonest length, not
    null or zero, and without null or non-finite components. Equal rows count once."""
    vector = F.col(vector_col).cast("array<double>")
    clean = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        "vec_id is not null and vector is not null "
        "and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        "and exists(vector, x -> x != 0)"
    )
    lengths = clean.groupBy(F.size("vector").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), "length").limit(1).collect()
    length = common[0].length if common else 0
    return clean.where(F.size("vector") == length).distinct()


def build_index(rows: DataFrame, most: int) -> DataFrame:
    """One row per shard with its graph as flat arrays, from ``usable`` rows.

    Equal vectors are one node; it holds their ``most`` least ids, which is all that a search for
    as many neighbours can return, so a vector that a third of all rows share is one node too.
    """
    first = Window.partitionBy("vector").orderBy("vec_id")
    nodes = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most)
    nodes = nodes.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    # Components are divided by the largest, so that squares neither overflow nor vanish.
    nodes = once(nodes, largest=F.greatest(F.array_max("vector"), -F.array_min("vector")))
    share = lambda x: x / F.col("largest")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + share(x) * share(x))
    doublings = F.log2("largest") + F.log2(squares) / 2
    band = F.floor((doublings - BAND_START) / BAND_DOUBLINGS)
    nodes = stored(nodes.select("vector", "members", band.alias("band")), "vectors")
    bands, shards = [], 0
    for row in nodes.groupBy("band").count().orderBy("band").collect():
        parts = -(-row["count"] // SHARD_ROWS)
        bands.append((row.band, shards, parts))
        shards += parts
    bands = rows.sparkSession.createDataFrame(bands, "band long, first_shard int, parts int")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group["id"].to_numpy()
        members = group["members"].to_pylist()
        vectors = np.array(group["vector"].to_pylist(), dtype=np.float64)
        graph = build(with_norm(vectors, norms(vectors).max()))
        return pa.table(
            {
                "shard": pa.array([group["shard"][0].as_py()], pa.int32()),
                "dimension": pa.array([vectors.shape[1]], pa.int32()),
                "ids": [ids.astype(np.int64).tobytes()],
                "members": [np.concatenate(members).astype(np.int64).tobytes()],
                "member_ends": [np.cumsum([len(m) for m in members]).astype(np.int64).tobytes()],
                "vectors": [vectors.tobytes()],
                "levels": [[n.astype(np.int32).tobytes() for n in graph.levels]],
                "links": [[n.tobytes() for n in graph.links]],
            }
        )

    least = F.element_at("members", 1)
    part = F.pmod(F.xxhash64(least), F.col("parts"))
    dealt = nodes.join(bands, "band").select(
        (F.col("first_shard") + part).cast("int").alias("shard"),
        least.alias("id"),
        "members",
        "vector",
    )
    return dealt.groupBy("shard").applyInArrow(run, SHARDS_DDL)


def norms(vectors: np.ndarray) -> np.ndarray:
    """The norms of vectors that are not zero, also where squares overflow or vanish."""
    largest = np.abs(vectors).max(axis=1)
    return largest * np.linalg.norm(vectors / largest[:, None], axis=1)


def with_norm(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors over ``longest``, with a component that brings all to the norm 1."""
    own = vectors / longest
    rest = np.clip(1 - np.einsum("nd,nd->n", own, own), 0, None)
    return np.concatenate([own, np.sqrt(rest)[:, None]], axis=1)


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = BEAM,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest of ``rows`` for each of ``queries``.

    Nearness is the inner product in double precision, ties go to the smaller id, and the query's
    own id is no candidate. The search is approximate (recall is measured in the tests); scores
    and order of what it finds are exact.

    Queries go in blocks to every shard, which returns its best ``k`` for each. Vectors that are
    null, zero, of another length than the commonest, or hold null or non-finite components take no
    part on either side; a row that is there twice counts once; two vectors of one id are two
    candidates; other columns are ignored; empty tables give no rows.
    """
    shards = stored(build_index(usable(rows, id_col, vector_col), k + 1), "shards")
    asked = stored(usable(queries, id_col, vector_col), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    last = shards.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    schema = "block int, query_ids binary, query_vectors binary"

    def gather(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        vectors = np.array(group["vector"].to_pylist(), dtype=np.float64)
        return pa.table(
            {
                "block": pa.array([group["block"][0].as_py()], pa.int32()),
                "query_ids": [group["vec_id"].to_numpy().tobytes()],
                "query_vectors": [vectors.tobytes()],
            }
        )

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    gathered = asked.withColumn("block", block).groupBy("block").applyInArrow(gather, schema)
    targets = F.explode(F.sequence(F.lit(0), F.lit(last)))
    work = gathered.withColumn("shard", targets).join(shards, "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _search_shard(row, k, beam)

    found = work.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_shard(row: dict, k: int, beam: int) -> pa.RecordBatch:
    width = row["dimension"]
    vectors = np.frombuffer(row["vectors"]).reshape(-1, width)
    queries = np.frombuffer(row["query_vectors"]).reshape(-1, width)
    query_ids = np.frombuffer(row["query_ids"], dtype=np.int64)
    members = np.frombuffer(row["members"], dtype=np.int64)
    ends = np.frombuffer(row["member_ends"], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    levels = [np.frombuffer(n, dtype=np.int32) for n in row["levels"]]
    links = [
        np.frombuffer(n, dtype=np.int32).reshape(len(nodes), -1)
        for n, nodes in zip(row["links"], levels)
    ]
    # The walk compares inner products with queries, to which the added component is zero. Their
    # order stays where queries and the shard as a whole are scaled to what float32 can hold.
    graph = Graph((vectors / norms(vectors).max()).astype(np.float32), levels, links)
    directions = (queries / norms(queries)[:, None]).astype(np.float32)
    found = search(graph, directions, max(beam, 2 * k))
    query, slot = np.nonzero(found >= 0)
    node = found[query, slot]
    scores = np.einsum("nd,nd->n", queries[query], vectors[node])
    lengths = ends[node] - starts[node]
    query, scores = np.repeat(query, lengths), np.repeat(scores, lengths)
    inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ids = members[np.repeat(starts[node], lengths) + inner]
    other = ids != query_ids[query]
    query, scores, ids = query[other], scores[other], ids[other]
    order = np.lexsort((ids, -scores, query))
    query, scores, ids = query[order], scores[order], ids[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[query[kept]]), pa.array(ids[kept]), pa.array(scores[kept])],
        names=["query_id", "vec_id", "score"],
    )
