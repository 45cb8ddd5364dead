import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from sensorloom.llm.queries import QUERIES
from sensorloom.llm.unigram import SPACE, VOCABULARY, Counter, read_vocabulary, token_counts


def library(vocabulary, byte_fallback=True):
    made = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    made.normalizer = normalizers.Sequence(
        [normalizers.Prepend(SPACE), normalizers.Replace(" ", SPACE)]
    )
    return made


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="module")
def both(vocabulary):
    return Counter(vocabulary), library(vocabulary)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab the  é日本\n\t<s>0x🙂Aß▁", max_size=50))
def test_counts_equal_the_library(both, text):
    ours, theirs = both
    assert ours.count(text) == len(theirs.encode(text, add_special_tokens=False).ids)


def test_ties_equal_the_library():
    draw = random.Random(0)
    for _ in range(200):
        pieces = {"a", "b", SPACE} | {
            "".join(draw.choice("ab" + SPACE) for _ in range(draw.randint(1, 4))) for _ in range(9)
        }
        scores = draw.choice([(-1.0, -2.0, -3.0), (-1.0, -1.5, -0.25)])
        vocabulary = [("<unk>", 0.0), *((p, draw.choice(scores)) for p in sorted(pieces))]
        ours, theirs = Counter(vocabulary), library(vocabulary, byte_fallback=False)
        for _ in range(20):
            text = "".join(draw.choice("ab ") for _ in range(draw.randint(0, 20)))
            assert ours.count(text) == len(theirs.encode(text).ids), (vocabulary, text)


def test_cutting_into_chunks_changes_nothing(both):
    ours = both[0]
    assert ours.cut
    text = "  Several words,   with spaces\nand lines  "
    assert ours.count(text) == ours.chunk(SPACE + text.replace(" ", SPACE))
    crossing = Counter([("<unk>", 0.0), ("a", -1.0), (f"a{SPACE}a", -1.0), (SPACE, -1.0)])
    assert not crossing.cut and crossing.count("a a") == 2


def test_query(spark, sf, both):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r.n_tokens for r in QUERIES["op5_unigram"](spark, sf).collect()}
    theirs = both[1]
    assert rows == {d: len(theirs.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}


def test_odd_rows(odd, empty, both):
    rows = token_counts(odd).collect()
    expected = [
        (r.doc_id, len(both[1].encode(r.text or "", add_special_tokens=False).ids))
        for r in odd.collect()
    ]
    assert sorted(map(repr, ((r.doc_id, r.n_tokens) for r in rows))) == sorted(map(repr, expected))
    assert token_counts(empty).count() == 0
