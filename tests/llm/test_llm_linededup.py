"""Line dedup against brute force, the perfect hash alone, and lines that many documents share."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.llm import linededup
from sensorloom.llm.linededup import contents, index_lines, without_common_lines
from sensorloom.llm.perfecthash import build, unpack

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def expected(texts, min_docs=10, min_chars=1):
    split = [(t or "").split("\n") for t in texts]
    keys = [[line.strip(BLANKS).translate(LOWER) for line in lines] for lines in split]
    docs = Counter(k for own in keys for k in set(own) if len(k) >= min_chars)
    out = []
    for lines, own in zip(split, keys):
        stay = [line for line, k in zip(lines, own) if docs[k] < min_docs]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def rows_of(frame):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept)
        for r in frame.collect()
    )


def make_texts(n, rng):
    lines = [f"Line number {i}" for i in range(60)]
    out = []
    for i in range(n):
        own = [lines[j] for j in rng.zipf(1.4, 8) % 60]
        own += ["", "  \t", f"only here {i}", " LINE number 1\r"]
        out.append("\n".join(rng.permutation(own).tolist()))
    return out


@settings(max_examples=30, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1)), max_size=300))
def test_perfect_hash(keys):
    keys = sorted(keys)
    high = np.array([k[0] for k in keys], dtype=np.uint64)
    low = np.array([k[1] for k in keys], dtype=np.uint64)
    counts = np.arange(1, len(keys) + 1)
    packed = build(high, low, counts).pack()
    found = unpack(**packed)
    assert len(found.fingerprints) == len(keys)  # minimal: no empty slot
    assert found.find(high, low).tolist() == counts.tolist()
    other = low ^ np.uint64(1)
    absent = [(h, o) not in set(keys) for h, o in zip(high.tolist(), other.tolist())]
    assert (found.find(high, other)[absent] == 0).all()


def test_perfect_hash_size():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 2**63, (2, 50_000)).astype(np.uint64)
    packed = build(high, low, np.full(50_000, 300)).pack()
    assert len(packed["bits"]) * 8 < 4.5 * 50_000
    assert len(packed["counts"]) == 2 * 50_000
    assert (unpack(**packed).find(high[::-1], low) > 0).sum() == 0


@pytest.mark.parametrize("resident_lines", [1 << 20, 8, 0])
def test_brute_force(spark, documents, resident_lines):
    """The same result whether all lines are resident, some of them or none."""
    texts = make_texts(200, np.random.default_rng(2))
    rows = list(enumerate(texts))
    got = without_common_lines(documents(rows).repartition(3), resident_lines=resident_lines)
    assert rows_of(got) == sorted((i, *e) for (i, _), e in zip(rows, expected(texts)))


def test_threshold_and_length(documents):
    texts = ["ab\nc\n\nlong line"] * 3 + ["c\nx"] * 2
    for min_docs, min_chars in [(1, 1), (1, 0), (3, 2), (4, 1), (5, 1), (6, 1), (3, 3)]:
        got = without_common_lines(
            documents(list(enumerate(texts))), min_docs=min_docs, min_chars=min_chars
        )
        want = expected(texts, min_docs, min_chars)
        assert rows_of(got) == sorted((i, *e) for i, e in enumerate(want))


def test_code_points(documents):
    texts = ["日本\n日本語"] * 2
    got = without_common_lines(documents(list(enumerate(texts))), min_docs=2, min_chars=3)
    assert [r[3] for r in rows_of(got)] == ["日本", "日本"]


@pytest.mark.parametrize("resident_lines", [1 << 20, 0])
def test_odd_rows(odd, resident_lines):
    texts = [r.text for r in odd.select("text").collect()]
    ids = [r.doc_id for r in odd.select("doc_id").collect()]
    got = without_common_lines(odd, min_docs=2, resident_lines=resident_lines)
    want = [(-1 if i is None else i, *e) for i, e in zip(ids, expected(texts, min_docs=2))]
    assert rows_of(got) == sorted(want)


def test_empty(empty):
    assert without_common_lines(empty).collect() == []


def test_only_shared_lines_are_indexed(documents):
    texts = ["shared\nalso\nown 1", "shared\nalso\nown 2", "shared\nown 3"]
    docs = documents(list(enumerate(texts)))
    assert contents(index_lines(docs)) == 2
    some = index_lines(docs, min_docs=2, resident_lines=1)
    assert (some.resident_from, some.shards, some.routed_shards) == (3, 1, 1)
    assert contents(some) == 2


def test_plan_has_no_join_while_lines_are_resident(documents):
    plan = without_common_lines(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_query(spark, sf):
    from sensorloom.llm.queries import op12_linededup

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = expected([r.text for r in docs])
    got = {r.doc_id: tuple(r)[1:] for r in op12_linededup(spark, sf).collect()}
    assert got == {
        r.doc_id: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for r, (n, gone, kept) in zip(docs, want)
    }
    assert any(gone for _, gone, _ in want)
    assert linededup.MIN_DOCS == 10


def test_extra_columns_are_ignored(odd):
    clashing = odd.withColumn("found", F.lit("own")).withColumn("kept", F.lit(1))
    assert without_common_lines(clashing).columns == ["doc_id", "n_lines", "n_dropped", "kept"]
