import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorloom.llm import suffix as S
from sensorloom.llm.queries import QUERIES


def brute_force(texts, length=100):
    """doc -> (bytes, spans, kept) by remembering every string; ids ascend."""
    seen, found = set(), {}
    for doc, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(gone, np.uint8), [0]])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        found[doc] = (len(data), spans, bytes(b for b, g in zip(data, gone) if not g))
    return found


def result(rows):
    return {
        r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in rows
    }


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60) | st.text(alphabet="ab", max_size=60).map(str.encode))
def test_suffix_order(text):
    assert S.suffix_order(text) == sorted(range(len(text)), key=lambda n: text[n:])


def test_suffix_order_of_repetitive_texts():
    fibonacci = [b"a", b"ab"]
    while len(fibonacci[-1]) < 1000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for text in (b"a" * 500, b"abc" * 200, fibonacci[-1], bytes(range(256)) * 3):
        assert S.suffix_order(text) == sorted(range(len(text)), key=lambda n: text[n:])


def random_texts(seed):
    random = np.random.default_rng(seed)
    words = ["".join(random.choice(list("abcdé"), random.integers(1, 8))) for _ in range(60)]
    passages = [" ".join(random.choice(words, random.integers(5, 60))) for _ in range(12)]
    texts = []
    for n in range(60):
        parts = [passages[k] for k in random.integers(0, 12, random.integers(0, 4))]
        parts += [" ".join(random.choice(words, random.integers(0, 40)))]
        if n % 7 == 0:
            parts += ["x" * int(random.integers(50, 400)), "ab" * int(random.integers(20, 200))]
        random.shuffle(parts)
        texts.append((n * 3, " ".join(parts)))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(documents, seed, monkeypatch):
    if seed == 1:
        monkeypatch.setattr(S, "SPLIT_STRETCHES", 2)  # windows go on their own
    if seed == 2:
        monkeypatch.setattr(S, "BLOCK_BYTES", 300)
    texts = random_texts(seed)
    found = result(S.without_repeats(documents(texts).repartition(5)).collect())
    assert found == brute_force(texts)


def test_stretches_cover_every_window_once():
    texts = [t for _, t in random_texts(9)] + ["", "short", "z" * 99, "z" * 100, "z" * 1000]
    data, borders = S.text_bytes(pa.array(texts))
    found = S.stretches(data, borders)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(found["first"], found["last"])])
    expected = [
        p for a, b in zip(borders, borders[1:]) for p in range(a, max(a, b - S.LENGTH + 1))
    ]
    assert sorted(covered.tolist()) == expected
    # Equal windows have the same anchor at the same place.
    where = {}
    for first, last, at, anchor in zip(*(found[c].tolist() for c in ("first", "last", "at", "anchor"))):
        for p in range(first, last + 1):
            assert p <= at <= p + S.LENGTH - S.ANCHOR
            window = data[p : p + S.LENGTH].tobytes()
            assert where.setdefault(window, (at - p, anchor)) == (at - p, anchor)


def test_merged():
    spans = S.merged(*map(np.array, ([1, 2, 1, 1, 2], [5, 0, 0, 9, 7], [9, 3, 2, 12, 9])))
    assert [c.tolist() for c in spans] == [[1, 1, 2, 2], [0, 5, 0, 7], [2, 12, 3, 9]]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    expected = brute_force([(d.doc_id, d.text) for d in docs])
    for r in QUERIES["op9_suffix"](spark, sf).collect():
        size, spans, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_spans) == (size, len(spans))
        assert r.n_removed == sum(b - a for a, b in spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_odd_rows(odd, empty):
    rows = S.without_repeats(odd).collect()
    distinct = {(r.doc_id, r.text or "") for r in odd.collect()}
    assert len(rows) == len(distinct)
    plain = "Some plain text of a few words, repeated. " * 8
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[9][0].kept == b"" and by_id[9][0].n_bytes == len(plain)
    assert all(by_id[n][0].spans == [] for n in (2, 3, 4, 5, 6))
    # The string at the start is the first of its kind; those at the places behind repeat it.
    assert bytes(by_id[7][0].kept) == b"x"
    first = next(r for r in by_id[1] if r.n_bytes == len(plain))
    assert bytes(first.kept) == brute_force([(1, plain)])[1][2]
    assert S.without_repeats(empty).count() == 0


def test_large_ids_that_repeat(documents):
    """Ids at both ends of their range, one of them twice, and one missing."""
    text = "some passage of text that several of the documents hold, and that is long enough " * 2
    ids = [2**63 - 1, -(2**63), 2**63 - 1, None, 7]
    rows = [(i, f"{n} {text}") for n, i in enumerate(ids)]
    found = S.without_repeats(documents(rows)).collect()
    whole = {r.doc_id for r in found if not r.spans}
    assert len(found) == 5 and whole == {-(2**63)}  # the least id has it first
