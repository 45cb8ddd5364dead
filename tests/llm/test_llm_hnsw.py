import math

import numpy as np
import pytest

from sensorloom.llm import hnsw as H
from sensorloom.llm.queries import QUERIES


def exact(rows, queries, k):
    """(query, rank, id, score) by comparing every query with every row."""
    found = []
    for query, vector in queries:
        scored = sorted(
            (-math.fsum(a * b for a, b in zip(vector, other)), own)
            for own, other in rows
            if own != query
        )
        found += [(query, n + 1, own, -s) for n, (s, own) in enumerate(scored[:k])]
    return found


def recall(rows, expected):
    found = {(r.query_id, r.vec_id) for r in rows}
    return np.mean([(q, v) in found for q, _, v, _ in expected])


def check_order(rows, k):
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
    for own in by_query.values():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1)) and len(own) <= k
        keys = [(-r.score, r.vec_id) for r in own]
        assert keys == sorted(keys) and len({r.vec_id for r in own}) == len(own)


def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    vectors = [(r.vec_id, [float(x) for x in r.embedding]) for r in table]
    expected = exact(vectors, [v for v in vectors if v[0] % 20 == 0], 20)
    rows = QUERIES["op8_hnsw"](spark, sf).collect()
    check_order(rows, 20)
    assert recall(rows, expected) >= 0.99
    scores = {(q, v): s for q, _, v, s in expected}
    for r in rows:
        if (r.query_id, r.vec_id) in scores:
            assert math.isclose(r.score, scores[r.query_id, r.vec_id], rel_tol=1e-12)


def test_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_ROWS", 400)
    monkeypatch.setattr(H, "QUERY_BLOCK", 40)
    random = np.random.default_rng(0)
    # Norms differ, so that the nearest by inner product are not the nearest by angle.
    vectors = random.normal(size=(1500, 24)) * random.uniform(0.2, 3, size=(1500, 1))
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = H.nearest(frame, frame.where("vec_id % 15 = 0"), 10).collect()
    check_order(found, 10)
    assert recall(found, exact(rows, rows[::15], 10)) >= 0.95


@pytest.mark.parametrize("longest", [1e4, 1e20, 1e160])
def test_recall_beside_an_outlier(spark, longest):
    random = np.random.default_rng(2)
    vectors = random.normal(size=(3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[7] *= longest
    vectors[45] /= longest
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = H.nearest(frame, frame.where("vec_id % 30 in (0, 7, 15)"), 10).collect()
    check_order(found, 10)
    asked = [r for r in rows if r[0] % 30 in (0, 7, 15)]
    assert recall(found, exact(rows, asked, 10)) >= 0.95


def test_graph_links_and_search():
    random = np.random.default_rng(1)
    vectors = random.normal(size=(3000, 16))
    vectors = H.with_norm(vectors, float(np.linalg.norm(vectors, axis=1).max()))
    graph = H.build(vectors)
    assert [len(n) for n in graph.levels] == sorted((len(n) for n in graph.levels), reverse=True)
    for level, (nodes, links) in enumerate(zip(graph.levels, graph.links)):
        assert links.shape == (len(nodes), H.LINKS * (1 + (level == 0)))
        assert np.isin(links[links >= 0], nodes).all()
        assert not (links == nodes[:, None]).any()
    queries = np.concatenate([random.normal(size=(50, 16)), np.zeros((50, 1))], axis=1)
    found = H.search(graph, queries.astype(np.float32), 100)
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    hits = [np.isin(b, f).mean() for b, f in zip(best, found)]
    assert np.mean(hits) >= 0.95


def test_equal_vectors_and_ties(spark):
    rows = [(n, [1.0, 0.0]) for n in range(200)] + [(500, [0.0, 1.0]), (501, [2.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = H.nearest(frame, frame.where("vec_id in (3, 100)"), 4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [
        (3, 1, 501), (3, 2, 0), (3, 3, 1), (3, 4, 2),
        (100, 1, 501), (100, 2, 0), (100, 3, 1), (100, 4, 2),
    ]


@pytest.mark.parametrize("k", [3, 50])
def test_odd_rows(spark, k):
    nan, inf = float("nan"), float("inf")
    good = [(n, [float(n % 5), 1.0, float(-n)]) for n in range(20)]
    bad = [
        (20, None), (21, [0.0, 0.0, 0.0]), (22, [1.0, None, 2.0]), (23, [nan, 1.0, 1.0]),
        (24, [inf, 1.0, 1.0]), (25, [1.0]), (26, []), (None, [1.0, 1.0, 1.0]), good[4],
    ]
    schema = "vec_id long, embedding array<double>, shard string, rank string"
    frame = spark.createDataFrame([(*r, "own", "own") for r in good + bad], schema)
    found = H.nearest(frame, frame.where("vec_id % 2 = 0"), k).collect()
    expected = exact(good, good[::2], k)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(
        e[:3] for e in expected
    )
    assert H.nearest(frame.limit(0), frame, k).count() == 0
    assert H.nearest(frame, frame.limit(0), k).count() == 0
