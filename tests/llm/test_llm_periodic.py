"""Periodic runs against a search of every period, and the convolution against plain sums."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorloom.llm import ntt, periodic
from sensorloom.llm.periodic import find_runs, periodic_runs
from sensorloom.llm.queries import with_repeated_tails


def brute_force(words):
    """(start, length, period) of all runs by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(words):
    start, end, period = find_runs(np.array(words, dtype=np.int64))
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist()))


def in_order(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("width", [1, 2, 4, 32, 256])
def test_squared_differences(width):
    rng = np.random.default_rng(width)
    blocks = rng.integers(0, ntt.PRIME, (3, width)).astype(np.uint64)
    windows = rng.integers(0, ntt.PRIME, (3, 2 * width)).astype(np.uint64)
    windows[1, width // 2 : width // 2 + width] = blocks[1]
    got = ntt.squared_differences(blocks, windows)
    want = [
        [
            sum((int(w[t + j]) - int(b[j])) ** 2 for j in range(width)) % ntt.PRIME
            for t in range(width)
        ]
        for b, w in zip(blocks, windows)
    ]
    assert got.tolist() == want
    assert got[1, width // 2] == 0


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_random_words(data):
    letters = data.draw(st.integers(1, 4))
    words = data.draw(st.lists(st.integers(0, letters - 1), max_size=90))
    assert found(words) == in_order(brute_force(words))


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_planted_period(data):
    """A stretch with a period of 1 to 40 words at any place, with a changed word somewhere."""
    period = data.draw(st.integers(1, 40))
    length = data.draw(st.integers(3 * period, 7 * period + 3))
    before = data.draw(st.integers(0, 30))
    base = [100 + i % period for i in range(length)]
    if data.draw(st.booleans()):
        base[data.draw(st.integers(0, length - 1))] = 7
    words = list(range(1000, 1000 + before)) + base + list(range(2000, 2010))
    assert found(words) == in_order(brute_force(words))


def test_small_chunks(monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK", 8)
    rng = np.random.default_rng(4)
    for _ in range(20):
        words = np.tile(rng.integers(0, 9, rng.integers(1, 20)), 6)[: rng.integers(0, 110)].tolist()
        assert found(words) == in_order(brute_force(words))


def test_texts_of_one_slice_do_not_mix():
    """Equal texts one behind the other are no run together."""
    texts = pa.array(["a b c d"] * 9 + ["", "x x x x x x", " x\tx\nx x x x "])
    words, borders, text, (start, end, period) = periodic.runs_of(texts)
    assert text.tolist() == [10, 11]
    assert (end - start).tolist() == [6, 6] and period.tolist() == [1, 1]
    assert (start - borders[text]).tolist() == [0, 0]


def rows_of(frame):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
        for r in frame.collect()
    )


def expected(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    runs = in_order(brute_force(words)) if len(words) < 5000 else None
    if runs is None:  # the one long text repeats a word
        assert len(set(words)) == 1
        runs = [(0, len(words), 1)]
    return (-1 if doc_id is None else doc_id, len(words), runs, collapse(words, runs))


def test_odd_rows(odd):
    want = [expected(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert rows_of(periodic_runs(odd)) == sorted(want)


def test_empty(empty):
    assert periodic_runs(empty).collect() == []


def test_every_column_null(documents):
    got = periodic_runs(documents([(None, None)] * 2)).collect()
    assert [(r.doc_id, r.n_words, r.runs, r.collapsed) for r in got] == [(None, 0, [], "")] * 2


def tail(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_tables_texts(spark, sf):
    """All documents, with the tails of the query, against the search of every period."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = {r.doc_id: r.text for r in with_repeated_tails(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = []
    for doc_id, text in texts.items():
        words = tail(doc_id, text)
        assert [w.decode() for w in (changed[doc_id] or "").encode().split()] == words
        rows.append(expected(doc_id, " ".join(words)))
    assert sum(1 for r in rows if r[2]) > 10
    assert rows_of(periodic_runs(with_repeated_tails(docs))) == sorted(rows)


def test_tails_of_odd_rows(odd):
    got = {(r.doc_id, " ".join((r.text or "").split(" "))) for r in with_repeated_tails(odd).collect()}
    assert (None, "No id, but a text with words.") in got
    assert (None, "") in got


def test_plan_has_no_shuffle(documents):
    plan = periodic_runs(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Exchange" not in plan
