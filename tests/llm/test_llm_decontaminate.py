import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorloom.llm import decontaminate as D
from sensorloom.llm.queries import QUERIES


def levenshtein(one, two):
    row = list(range(len(two) + 1))
    for i, x in enumerate(one):
        new = [i + 1]
        for j, y in enumerate(two):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def split(text):
    """The words of a text, by a pattern of its own."""
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def nearest_span(item, text):
    """Least distance of the item to any span of the text: the plain table, with free ends."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in text:
        new = [0]
        for i, own in enumerate(item):
            new.append(min(row[i + 1] + 1, new[i] + 1, row[i] + (own != word)))
        row = new
        best = min(best, row[-1])
    return best


def brute_force(texts, items):
    """(text, item) where some span of the text, of any length, is within the distance."""
    found = set()
    split_texts = [split(t) for t in texts]
    pairs_of = [set(zip(t, t[1:])) for t in split_texts]
    for item, text in items:
        own = split(text)
        if len(own) < 5:
            continue
        pairs = set(zip(own, own[1:]))
        repeated = len(own) - 1 - len(pairs)
        for n, words in enumerate(split_texts):
            # Cheap bound first: an edit of a word costs two pairs at most.
            if len(pairs & pairs_of[n]) + repeated < len(own) - 1 - 2 * int(0.2 * len(own)):
                continue
            if nearest_span(own, words) <= int(0.2 * len(own)):
                found.add((n, item))
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(2, 5), min_size=1, max_size=12), st.lists(st.integers(2, 5), max_size=20))
def test_best_span(one, two):
    distance, start, end = D.best_span(one, two)
    assert distance == nearest_span(one, two) == levenshtein(one, two[start:end])


def test_best_spans_of_many():
    random = np.random.default_rng(0)
    for length in (1, 5, 63, 64, 65, 80):
        one = random.integers(2, 6, (20, length)).astype(np.uint64)
        two = random.integers(2, 6, (20, length + 10)).astype(np.uint64)
        got = zip(*(c.tolist() for c in D.best_spans(one, two)))
        assert list(got) == [D.best_span(a, b) for a, b in zip(one.tolist(), two.tolist())]


def search_texts(texts, items):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    return D.search(batch, 0, D.build_index(items))


@pytest.mark.parametrize("length", [5, 10, 20, 40, 64, 100])
@pytest.mark.parametrize("kind", D.KINDS)
def test_recall_at_the_largest_distance(length, kind):
    """Copies with as many edits as are allowed, in foreign text: 95 of 100 and more are found."""
    random = np.random.default_rng(length)
    items = [(n, " ".join(f"w{k}" for k in random.integers(0, 3000, length))) for n in range(10)]
    texts = []
    for n in range(100):
        words = items[n % 10][1].split()
        copy = D.edited_copy(words, D.allowed(length), kind, random, lambda r: f"new{r.integers(9999)}")
        foreign = [f"foreign{k}" for k in random.integers(0, 9999, 60)]
        cut = int(random.integers(60))
        texts.append(" ".join([*foreign[:cut], *copy, *foreign[cut:]]))
    found = {(m[0], m[1]) for m in search_texts(texts, items)}
    assert found <= brute_force(texts, items)
    assert sum((n, n % 10) in found for n in range(100)) >= 95


def test_whole_texts_that_lost_words():
    """A text that is the item less some words, from its start, middle or end, and nothing else."""
    words = [f"w{n}" for n in range(40)]
    texts = [
        " ".join(words[:n] + words[n + lost :]) for lost in (1, 4, 8) for n in (0, 1, 20, 40 - lost)
    ]
    found = search_texts(texts, [(7, " ".join(words))])
    assert {m[0] for m in found} == set(range(len(texts)))
    assert all(m[2] == 0 and m[3] == len(texts[m[0]].split()) for m in found)
    too_far = [" ".join(words[9:]), " ".join(words[:10] + words[19:])]
    assert search_texts(too_far, [(7, " ".join(words))]) == []


def test_exact_pass_where_keys_would_miss(monkeypatch):
    monkeypatch.setattr(D, "MAX_REPETITIONS", 1)
    words = [f"w{n}" for n in range(40)]
    index = D.build_index([(1, " ".join(words))])
    assert index.repetitions == {40: 0}
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(["x"] + words[8:] + ["y"])])], ["text"])
    assert [(m[1], m[4]) for m in D.search(batch, 0, index)] == [(1, 8)]


def edited(text, random, rate):
    words = text.split()
    for _ in range(int(rate * len(words))):
        n = int(random.integers(len(words)))
        kind = random.integers(3)
        if kind == 0:
            words[n] = f"changed{random.integers(1000)}"
        elif kind == 1:
            words.insert(n, f"new{random.integers(1000)}")
        elif len(words) > 1:
            del words[n]
    return " ".join(words)


def test_planted_items_are_found_like_by_brute_force(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    documents = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    random = np.random.default_rng(1)
    texts = []
    for n, (_, text) in enumerate(items):
        base = documents[n % 40][:600].split()
        middle = edited(text, random, 0.05 * (n % 5)).upper().replace(" ", " -- ")
        texts.append(" ".join([*base[:20], middle, *base[20:]]))
    texts += [d[:600] for d in documents]
    index = D.build_index(items)
    assert all(1 <= r <= D.MAX_REPETITIONS for r in index.repetitions.values())
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = {(m[0], m[1]) for m in D.search(batch, 0, index)}
    expected = brute_force(texts, items)
    assert found <= expected
    assert len(found) >= 0.97 * len(expected)
    assert len(expected) >= 0.7 * len(items)


def test_likely_windows_lose_nothing():
    random = np.random.default_rng(2)
    item = " ".join(f"w{n}" for n in random.integers(0, 50, 30))
    index = D.build_index([(1, item)])
    for _ in range(30):
        text = f"a b c {edited(item, random, 0.2)} d e f g h"
        words, borders = D.word_ids(pa.array([text]))
        own = D.word_ids(pa.array([item]))[0].tolist()
        # Starts of spans of any length within the distance.
        whole = words.tolist()
        near = {
            s
            for s in range(len(whole))
            for n in range(24, 37)
            if s + n <= len(whole) and levenshtein(own, whole[s : s + n]) <= D.allowed(30)
        }
        likely = {s for _, found in D._likely_windows(words, borders, index) for s in found.tolist()}
        assert near <= likely


def test_query(spark, sf):
    rows = QUERIES["op3_decontaminate"](spark, sf).collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    expected = brute_force([d.text for d in docs], items)
    found = {(r.doc_id, r.item_id) for r in rows}
    expected = {(docs[t].doc_id, i) for t, i in expected}
    assert found <= expected and len(found) >= 0.99 * len(expected)


def test_blocks_of_items(spark, documents, monkeypatch):
    items = [(n, " ".join(f"t{n}w{k}" for k in range(10))) for n in range(6)]
    docs = documents([(n, f"start {text} end") for n, text in items])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_CHARS", 100)
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, benchmark).collect()}
    assert found == {(n, n) for n in range(6)}
    assert D.without_contaminated(docs, benchmark).count() == 0


def test_odd_rows(odd, empty, spark):
    items = [(1, "some plain text of a few"), (2, None), (None, "word word word word word"), (4, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.contaminated(odd, benchmark).select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in found} == {(1, 1), (9, 1), (8, None)}
    left = D.without_contaminated(odd, benchmark)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
    assert D.contaminated(empty, benchmark).count() == 0
    no_items = benchmark.limit(0)
    assert D.contaminated(odd, no_items).count() == 0
    assert D.without_contaminated(odd, no_items).count() == odd.count()
