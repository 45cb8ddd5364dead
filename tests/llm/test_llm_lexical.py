"""Lexical search against a score of every document, on odd tables and with small shards."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sensorloom.llm import lexical
from sensorloom.llm.lexical import build_index, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=50):
    """item_id to [(score, doc_id)], each document scored whole."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs = len(counted)
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        own = set(terms(text))
        scored = []
        for doc_id, c in counted:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in own
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def random_table(rng, n):
    words = [f"w{i}" for i in range(40)]
    return [
        (i, " ".join(words[j % 40] for j in rng.zipf(1.3, rng.integers(0, 60)))) for i in range(n)
    ]


@pytest.mark.parametrize("postings,first", [(1 << 20, 256), (200, 256), (200, 1), (1, 4)])
def test_brute_force(monkeypatch, documents, items, postings, first):
    """Many shards, and few strata at first, leave the result as it is."""
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical, "FIRST_DOCS", first)
    monkeypatch.setattr(lexical, "SLICE_BYTES", 500)
    rng = np.random.default_rng(3)
    docs = random_table(rng, 300)
    wanted = [(i, t) for i, (_, t) in enumerate(random_table(rng, 30))]
    index = _in_one_process(documents(docs))
    got = rows_of(search(index, items(wanted), top=7))
    assert got == expected(docs, wanted, 7)


def _in_one_process(frame):
    """Workers do not see patched settings: the index is built from one batch here."""
    import pyarrow as pa

    rows = frame.select("doc_id", "text").collect()
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": [r.doc_id for r in rows], "text": [r.text for r in rows]},
        pa.schema([("doc_id", pa.int64()), ("text", pa.string())]),
    )
    counted = next(lexical._lengths(iter([batch.select(["text"])])))
    n_docs, n_terms = counted.column(0)[0].as_py(), counted.column(1)[0].as_py()
    shards, shard = [], lexical._Shard()
    for part in lexical.slices(batch, 1, lexical.SLICE_BYTES):
        shard.add(part)
        if shard.postings >= lexical.SHARD_POSTINGS:
            shards.append(shard.row(n_docs, n_terms))
            shard = lexical._Shard()
    if shard.postings:
        shards.append(shard.row(n_docs, n_terms))
    if lexical.SHARD_POSTINGS < 1000:
        assert len(shards) > 5
    stored = frame.sparkSession.createDataFrame(pa.Table.from_batches(shards))
    return lexical.Index(stored, n_docs, n_terms)


def test_strata_are_left_out():
    """Where the list is full of better scores, long documents are not visited."""
    import pyarrow as pa

    texts = ["needle " + "hay " * 3] * 300 + ["needle " + "hay " * 300] * 60
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(360)), "text": texts})
    shard = lexical._Shard()
    shard.add(batch)
    total = sum(len(t.split()) for t in texts)
    row = shard.row(360, total)
    query = lexical._queries([(1, "needle")])
    query.weights = np.array([1000])
    opened = lexical._Opened({c: row.column(c)[0] for c in row.schema.names}, query)
    visited = []
    opened._visit = lambda groups, stratum, order, found: (
        visited.extend(order.tolist()),
        lexical._Opened._visit(opened, groups, stratum, order, found),
    )
    found = lexical._Best(50)
    opened.search(query.items[0], found)
    assert visited == [0] and len(opened.stratum_docs) == 2
    assert found.ids.tolist() == list(range(50))


def test_odd_rows(odd, items):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    wanted = [
        (1, "Some plain TEXT, words 12"),
        (1, "word"),
        (2, None),
        (3, ""),
        (4, "?!"),
        (None, "日本語 with x"),
        (5, "word " * 30_000),
        (6, "absent"),
        (7, "é́ русский 1f 5"),
    ]
    got = rows_of(search(build_index(odd), items(wanted)))
    assert got == expected(docs, wanted)


def test_ties_go_to_the_smaller_id(documents, items):
    docs = [(100 - i, "same words here") for i in range(80)] + [(None, "same words here")]
    got = rows_of(search(build_index(documents(docs).repartition(4)), items([(9, "words")])))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(21, 71))


def test_empty_tables(documents, items, empty):
    full = documents([(1, "a")])
    assert search(build_index(empty), items([(1, "a")])).collect() == []
    assert search(build_index(full), items([])).collect() == []
    assert search(build_index(documents([(1, None), (2, "?")])), items([(1, "a")])).collect() == []


def test_blocks_of_items(monkeypatch, documents, items):
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 40)
    docs = random_table(np.random.default_rng(5), 40)
    wanted = [(i, t) for i, (_, t) in enumerate(random_table(np.random.default_rng(6), 8))]
    assert rows_of(search(build_index(documents(docs)), items(wanted))) == expected(docs, wanted)


def test_index_holds_every_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    index = build_index(docs)
    counted = defaultdict(int)
    for r in docs.collect():
        counted["docs"] += bool(terms(r.text))
        counted["terms"] += len(terms(r.text))
    assert (index.docs, index.terms) == (counted["docs"], counted["terms"])
    assert sum(len(r.doc_ids) for r in index.shards.collect()) == index.docs


def test_query_brute_force(spark, sf):
    from sensorloom.llm.queries import op11_lexical

    tables = [
        [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    ]
    assert rows_of(op11_lexical(spark, sf)) == expected(*tables)
