import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from sensorloom.llm import brown as B
from sensorloom.llm.common import words
from sensorloom.llm.queries import QUERIES


def base_scores(texts, held):
    counts = Counter()
    for doc, text in texts.items():
        if doc is not None and not held(doc):
            counts.update([*words(text or ""), "\n"])
    total, distinct = sum(counts.values()), len(counts)

    def score(text):
        tokens = [*words(text or ""), "\n"]
        value = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        return len(tokens), sum(counts[t] > 0 for t in tokens), total, value

    return {doc: score(text) for doc, text in texts.items()}


def test_query(spark, sf, monkeypatch):
    # Few known words, so that most are looked up by the join.
    monkeypatch.setattr(B, "KNOWN", 300)
    monkeypatch.setattr(B, "CLUSTERED", 100)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_brown"](spark, sf).collect()
    expected = base_scores(texts, lambda d: zlib.crc32(str(d).encode()) % 7 == 2)
    assert len(rows) == len(texts)
    for r in rows:
        tokens, known, total, value = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, total)
        assert math.isclose(r.base_score, value, rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def likelihood(bigrams, owner, classes):
    """What exchange clustering maximises, from its definition."""
    total = classes + len(bigrams) - len(owner)
    full = np.concatenate([owner, np.arange(classes, total)])
    table = np.zeros((total, total))
    np.add.at(table, (full[:, None], full[None, :]), bigrams)
    h = lambda x: float(np.sum(x * np.log(np.maximum(x, 1))))
    return h(table) - h(table.sum(axis=0)) - h(table.sum(axis=1))


def test_exchange_reaches_a_local_optimum():
    random = np.random.default_rng(0)
    size = 24
    bigrams = np.zeros((size + 3, size + 3), dtype=np.int64)
    kind = random.integers(0, 4, size)
    for _ in range(6000):
        a, b = random.integers(0, size, 2)
        if random.random() < (0.9 if kind[b] == (kind[a] + 1) % 4 else 0.05):
            bigrams[a, b] += 1
    bigrams[-1, :size] = bigrams[:size, -1] = random.integers(0, 5, size)
    owner = B.exchange(bigrams, size, 4)
    best = likelihood(bigrams, owner, 4)
    assert best > likelihood(bigrams, np.arange(size) % 4, 4)
    for word in range(size):
        for other in range(4):
            moved = owner.copy()
            moved[word] = other
            assert likelihood(bigrams, moved, 4) <= best + 1e-6
    assert all(len(set(owner[kind == k])) == 1 for k in range(4))


def test_probabilities_sum_to_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    counts = B.count_words(docs)
    model = B.fit(docs, counts)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    emitted = 10**model.emission
    sums = np.bincount(model.known_classes, emitted, len(model.transition))
    clustered = sums[: model.rest]
    assert np.allclose(clustered[clustered > 0], 1)
    # Every word that was counted has a class from the clustering; shapes are for new words.
    assert len(model.known) == counts.count() and (model.known_classes < model.rest).all()
    assert (sums[model.rest :] == 0).all() and (10**model.new_word <= 1).all()


def sentences(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: words(r.text or "") for r in rows}


def test_words_go_where_their_neighbours_make_them_likeliest(spark, sf):
    """The assignment against its definition, summed over all occurrences one by one."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = list(sentences(spark, sf).values())
    counted = Counter(w for own in texts for w in own)
    known = sorted(counted, key=lambda w: (-counted[w], w))
    hashes = {w: int(B.read_words(pa.array([w]))[0][0]) for w in known}
    shapes = {w: int(B.read_words(pa.array([w]))[1][0]) for w in known}
    seeds = {w: n % 4 for n, w in enumerate(known[:40])}
    symbol = {w: seeds.get(w, 4 + shapes[w]) for w in known}
    border, width = 4 + B.SHAPES, 5 + B.SHAPES
    random = np.random.default_rng(0)
    gains = random.normal(size=(2 * width, 4))
    sums = {w: np.zeros(4) for w in known[40:]}
    for own in texts:
        around = [border, *(symbol[w] for w in own), border]
        for n, w in enumerate(own):
            if w in sums:
                sums[w] += gains[around[n + 2]] + gains[width + around[n]]
    order = sorted(known, key=hashes.get)
    place, owner = B.assign_classes(
        docs,
        np.array([hashes[w] for w in order], dtype=np.uint64),
        np.array([symbol[w] for w in order]),
        np.array([w not in seeds for w in order]),
        gains,
    )
    got = {order[p]: k for p, k in zip(place.tolist(), owner.tolist())}
    assert set(got) == set(sums)
    assert all(sums[w][k] >= sums[w].max() - 1e-6 for w, k in got.items())


def test_scores_from_texts_and_classes_alone(spark, sf):
    """Transitions, emissions and all scores counted again in plain Python."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    counts = B.count_words(docs)
    model = B.fit(docs, counts)
    texts = sentences(spark, sf)
    counted = Counter(w for own in texts.values() for w in own)
    place = {int(h): n for n, h in enumerate(model.known.tolist())}
    class_of = {
        w: int(model.known_classes[place[int(B.read_words(pa.array([w]))[0][0])]]) for w in counted
    }
    follows = Counter()
    for own in texts.values():
        states = [model.border, *(class_of[w] for w in own), model.border]
        follows.update(zip(states, states[1:]))
    members = Counter()
    for w, n in counted.items():
        members[class_of[w]] += n
    # Without the share of new words, which every row gives away in the same way.
    table = np.zeros((model.border + 1,) * 2)
    for (a, b), n in follows.items():
        table[a, b] = n
    rows = B.score(docs.selectExpr("*", "false as held_out"), model, counts).collect()
    for r in rows:
        states = [model.border, *(class_of[w] for w in texts[r.doc_id]), model.border]
        value = sum(model.transition[a, b] for a, b in zip(states, states[1:]))
        value += sum(math.log10(counted[w] / members[class_of[w]]) for w in texts[r.doc_id])
        assert math.isclose(r.score, value, rel_tol=1e-9)
    # Transitions keep to what was counted: of frequent pairs, the more frequent is likelier.
    for a in range(model.rest):
        kept = [b for b in range(model.rest) if table[a, b] >= 50]
        by_count = sorted(kept, key=lambda b: table[a, b])
        values = [model.transition[a, b] for b in by_count]
        assert all(x <= y + 0.05 for x, y in zip(values, values[1:]))


def test_score_of_a_text_by_hand(documents):
    docs = documents([(1, "a b a b c."), (2, "a b a b"), (3, None)]).select("doc_id", "text")
    counts = B.count_words(docs)
    model = B.fit(docs, counts)
    row = B.score(docs.selectExpr("doc_id", "text", "false as held_out"), model, counts)
    row = {r.doc_id: r for r in row.collect()}
    hashes, shapes, _ = B.read_words(pa.array(["a b a b"]))
    places = [int(np.flatnonzero(model.known == h)[0]) for h in hashes]
    states = [model.border, *(model.known_classes[p] for p in places), model.border]
    value = sum(model.transition[a, b] for a, b in zip(states, states[1:]))
    value += sum(model.emission[p] for p in places)
    assert math.isclose(row[2].score, value, rel_tol=1e-12)
    assert row[3].n_tokens == 1 and row[3].n_known == 1


def test_odd_rows(odd, empty):
    docs = odd.select("doc_id", "text")
    counts = B.count_words(docs)
    model = B.fit(docs, counts)
    rows = B.score(odd.selectExpr("*", "true as held_out"), model, counts).collect()
    assert len(rows) == odd.count()
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert sorted(r.n_tokens for r in rows) == sorted(
        len(words(r.text or "")) + 1 for r in odd.collect()
    )
    none = empty.select("doc_id", "text")
    model = B.fit(none)
    assert B.score(none.selectExpr("*", "true as held_out"), model, B.count_words(none)).count() == 0
    unseen = B.score(docs.selectExpr("*", "true as held_out"), model, B.count_words(none)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in unseen)
