import zlib

import numpy as np
import pyarrow as pa
import pytest

from sensorloom.llm import toxicity as X
from sensorloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def trigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return X.language_model(X.trigram_counts(docs))


@pytest.mark.parametrize(
    "disguised, plain",
    [
        ("p@thetic", "pathetic"),
        ("1d10t", "idiot"),
        ("m0r0n", "moron"),
        ("tr@sh!!!", "trash"),
        ("stuuuupid", "stupid"),
        ("i d i o t", "idiot"),
        ("m.o.r.o.n", "moron"),
        ("l0$er", "loser"),
        ("mоron", "moron"),  # with a Cyrillic o
    ],
)
def test_restoration(trigrams, disguised, plain):
    restored = X.Restorer(trigrams).texts(pa.array([f"and {disguised.upper()} of"])).to_pylist()
    assert restored == [f"and {plain} of"]


def test_plain_texts_are_only_lower_cased(trigrams):
    texts = ["This and that, in 2024.", "", None, "Ünïcode Words - 12.5 (x) a.", "thonner$$$ ###"]
    expected = [(t or "").lower() for t in texts]
    assert X.Restorer(trigrams).texts(pa.array(texts)).to_pylist() == expected


def test_viterbi_is_the_best_of_all_paths(trigrams):
    """Against listing every path through the lattice."""
    for text in ("t3n", "0n3", "a1l", "xxxa", "h.e"):
        paths = [(0.0, "")]
        for options in X._readings(text):
            paths = [(s + c, made + x) for s, made in paths for x, c in options]
        scored = []
        for cost, made in paths:
            score, a, b, shown = cost, 0, 0, ""
            for letter in made:
                if letter == " " and b == 0:
                    continue
                c = 0 if letter == " " else ord(letter) - 96
                score += trigrams[a, b, c]
                a, b, shown = b, c, shown + letter
            scored.append((score + trigrams[a, b, 0], shown))
        best = max(s for s, _ in scored)
        restored = X.restore(text, trigrams)
        assert any(made == restored and abs(s - best) < 1e-9 for s, made in scored)


def test_language_model_is_a_distribution(trigrams):
    assert np.allclose(np.exp(trigrams).sum(axis=2), 1)


def area(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    positive = label == 1
    n = positive.sum()
    return (rank[positive].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op10_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in held])
    assert area(truth, np.array([r.score for r in held])) > 0.85
    assert np.mean(truth == [r.predicted for r in held]) > 0.93


def test_disguised_words_score_like_plain_ones(spark, documents):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = X.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "text", "toxic")
    words = "the and of in that with for are this from"
    tests = documents([
        (1, f"{words} stupid {words} idiot {words} pathetic"),
        (2, f"{words} stuuuupid {words} 1D10T {words} p@thet1c"),
        (3, f"{words} {words} {words}"),
    ])
    found = {r.doc_id: r.score for r in X.score(tests, model).collect()}
    assert found[1] > 0.9 and found[2] > 0.9 and found[3] < 0.5


def test_odd_rows(odd, empty, spark):
    schema = "doc_id long, toxic int"
    labels = spark.createDataFrame(
        [(1, 1), (5, 0), (5, 0), (9, 0), (None, 1), (6, None), (77, 1), (8, 3)], schema
    )
    model = X.fit(odd, labels, "doc_id", "text", "toxic")
    rows = X.score(odd, model, keep=("key",)).collect()
    assert len(rows) == odd.count() and {r.key for r in rows} == {"own key"}
    blank = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1
    for few in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = X.fit(odd, few, "doc_id", "text", "toxic")
        assert len({r.score for r in X.score(odd, model).collect()}) == 1
    model = X.fit(empty, labels, "doc_id", "text", "toxic")
    assert X.score(empty, model).count() == 0
