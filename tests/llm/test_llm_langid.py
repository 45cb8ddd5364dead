import zlib

import numpy as np
import pyarrow as pa

from sensorloom.llm import langid
from sensorloom.llm.queries import QUERIES


def test_query_on_held_out_rows(spark, sf):
    rows = QUERIES["op2_langid"](spark, sf).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(langs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in langs if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.rejected for r in rows)


def test_vectors_are_normalised_and_only_letters_count():
    raw, lettered = langid.counts(pa.array(["some words", None, "", "123 !?", "яблоко", "€ 5"]))
    assert lettered.tolist() == [True, False, False, False, True, False]
    assert raw[1:4].sum() == 0
    lengths = np.linalg.norm(langid.vectors(raw, np.ones(langid.DIMENSIONS)), axis=1)
    assert np.allclose(lengths[[0, 4]], 1)
    same = langid.counts(pa.array(["SOME, words", "some  words"]))[0]
    assert np.array_equal(same[0] > 0, same[1] > 0)


def test_prediction_is_the_nearest_centroid(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs, "doc_id", "text", "lang")
    assert len(model.languages) <= 4 * langid.CLUSTERS
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-3)
    rows = docs.limit(40).collect()
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    points = langid.vectors(langid.counts(pa.array([r.text for r in rows]))[0], model.idf)
    for r, point in zip(rows, points):
        cosines = model.centroids @ point
        assert found[r.doc_id].lang_pred == model.languages[int(np.argmax(cosines))]
        assert abs(found[r.doc_id].score - min(1, cosines.max())) < 1e-5


def test_far_texts_are_rejected_and_clean_ones_kept(documents, spark, sf):
    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text", "lang")
    far = documents([(1, "日本語のテキスト" * 20), (2, "русский текст который " * 9), (3, "12 !")])
    assert all(r.rejected for r in langid.predict(far, model).collect())


ITALIAN = (
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era "
    "smarrita. Ahi quanto a dir qual era è cosa dura esta selva selvaggia e aspra e forte. "
)
DUTCH = (
    "De kat zit op de mat en kijkt naar buiten, waar het regent en de mensen met hun paraplu's "
    "over straat lopen om op tijd bij het station te komen. Wij gaan morgen naar het strand. "
)


def test_long_texts_of_unlearned_kinds_go_and_short_clean_ones_stay(documents, spark, sf):
    random = np.random.default_rng(0)
    drawn = lambda signs, n: "".join(random.choice(list(signs), n))
    letters = "abcdefghijklmnopqrstuvwxyz"
    far = [ITALIAN * 10, DUTCH * 10, drawn(letters, 2000), drawn("0123456789abcdef", 2000)]
    far.append(" ".join(drawn(letters, n) for n in random.integers(2, 9, 400)))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    # A source of very short rows says nothing on long ones.
    short = docs.selectExpr("doc_id", "substring(text, 1, 4) as text", "lang")
    for training in (docs, docs.select("doc_id", "text", "lang").union(short)):
        model = langid.fit(training, "doc_id", "text", "lang")
        rows = langid.predict(documents(list(enumerate(far))), model).collect()
        assert all(r.rejected for r in rows)
        # Beginnings of learned texts, as long as a line.
        lines = docs.selectExpr("substring(text, 1, 60) as text").where("length(text) = 60")
        rows = langid.predict(lines, model).collect()
        assert np.mean([r.rejected for r in rows]) < 0.01


def test_odd_rows(odd, empty):
    model = langid.fit(odd, "doc_id", "text", "lang")  # no row has a language
    for r in langid.predict(odd, model).collect():
        assert r.lang_pred == "und" and r.rejected == (not any(c.isalpha() for c in r.text or ""))
    labelled = odd.withColumn("lang", odd.source.isNull().cast("string"))
    model = langid.fit(labelled, "doc_id", "text", "lang")
    found = langid.predict(odd, model)
    assert found.columns[-3:] == ["lang_pred", "score", "rejected"]
    for r in found.collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("true" if lettered else "und")
        assert r.key == "own key" and (lettered or (r.rejected and r.score == 0))
    assert langid.predict(empty, langid.fit(empty, "doc_id", "text", "lang")).count() == 0
