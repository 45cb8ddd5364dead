import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorloom.llm.packing import VOCABULARY, Packer, encoder, pack
from sensorloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def check_pieces(rows, documents, capacity=1024):
    """Each id of each document is in one piece, and sequences are gapless."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, ids, total, sequence, offset in rows:
        assert len(ids) == 4 * length and length > 0
        by_doc[doc].append((start, ids, total))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(documents)
    for doc, ids in documents.items():
        pieces = sorted(by_doc[doc])
        assert b"".join(p[1] for p in pieces) == ids.tobytes()
        assert [p[0] for p in pieces] == [
            sum(len(q[1]) for q in pieces[:n]) // 4 for n in range(len(pieces))
        ]
        assert {p[2] for p in pieces} == {len(ids)}
    padding = 0
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        padding += capacity - end if end & (end - 1) else 0
    return padding


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60), st.integers(1, 12))
def test_every_id_is_packed_once(sizes, max_open):
    documents = {n: np.arange(s, dtype="<u4") + n * 100 for n, s in enumerate(sizes)}
    packer = Packer(16, 5 << 40, max_open)
    for doc, ids in documents.items():
        packer.add(doc, ids)
    packer.merge(last=True)
    assert check_pieces(packer.closed, documents, 16) == 0
    assert packer.count == 0


def test_placement_minimises_the_sum_of_squares():
    packer = Packer(10, 0)
    random = np.random.default_rng(0)
    for doc, size in enumerate(random.integers(1, 10, 300).tolist()):
        before = [len(w) for w in packer.windows]

        def squares(level, size=size, before=before):
            counts = list(before)
            if level:
                counts[level] -= 1
            if level + size < 10:
                counts[level + size] += 1
            return sum(c * c for c in counts)

        open_levels = [0] + [n for n in range(1, 11 - size) if before[n]]
        best = min(squares(n) for n in open_levels)
        packer.add(doc, np.zeros(size, dtype="<u4"))
        assert sum(len(w) ** 2 for w in packer.windows) == best


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_ids_equal_the_tokenizers_library(tokenizer, text):
    text = text.encode("utf-8", "ignore").decode()
    ours = encoder(public_tokenizers.path(VOCABULARY)).encode(text, allowed_special="all")
    assert ours == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "<|endoftext", "<| endoftext|>"]
)
def test_special_strings_are_their_tokens(documents, tokenizer, text):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(public_tokenizers.path(VOCABULARY)).encode(text, allowed_special="all") == want
    assert (50256 in want) == ("<|endoftext|>" in text)
    pieces = sorted(pack(documents([(1, text)])).collect(), key=lambda p: p.start)
    assert np.frombuffer(b"".join(p.ids for p in pieces), dtype="<u4").tolist() == [*want, 0]


def test_query(spark, sf, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op1_pack"](spark, sf).collect()
    documents = {
        d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for d, t in texts.items()
    }
    full = []
    for r in rows:
        ids = documents[r.doc_id][r.start : r.start + r.length].tobytes()
        assert zlib.crc32(ids) == r.ids_crc32
        full.append((r.doc_id, r.start, r.length, ids, r.doc_tokens, r.sequence_id, r.offset))
    assert check_pieces(full, documents) == 0


def test_odd_rows(odd, empty, tokenizer):
    rows = pack(odd).collect()
    expected = [
        len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
        for r in odd.collect()
    ]
    assert sum(r.length for r in rows) == sum(expected)
    assert pack(empty).count() == 0
