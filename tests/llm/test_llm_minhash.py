import numpy as np
import pyarrow as pa

from sensorloom.llm import minhash as M
from sensorloom.llm.common import words
from sensorloom.llm.components import components
from sensorloom.llm.queries import QUERIES


def sets_of(texts):
    found = {}
    for doc, text in texts.items():
        own = words(text or "")
        if len(own) >= 5:
            found[doc] = {tuple(own[n : n + 5]) for n in range(len(own) - 4)}
        else:
            found[doc] = {tuple(own)} if own else set()
    return found


def brute_force(texts):
    """doc -> (set size, least id reachable), from all pairs of sets."""
    sets = sets_of(texts)
    least = {d: d for d in sets}
    ids = sorted(sets)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {d: (len(sets[d]), least[d]) for d in ids}


def result(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_query_like_all_pairs(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert result(QUERIES["op6_minhash"](spark, sf)) == brute_force(texts)


def test_groups_of_near_copies_like_all_pairs(documents):
    random = np.random.default_rng(3)
    texts = {}
    for group in range(3):
        base = [f"g{group}w{n}" for n in random.integers(0, 400, 120)]
        for copy in range(40):
            own = list(base)
            # From no change to changes that part copies from the first, not from each other.
            for n in random.integers(0, len(own), copy % 7):
                own[n] = f"other{random.integers(10**6)}"
            texts[group * 100 + copy] = " ".join(own)
    for n in range(20):
        texts[1000 + n] = "one short text " + "x" * (n % 3)
    rows = [(d, t) for d, t in texts.items()]
    assert result(M.near_duplicates(documents(rows))) == brute_force(texts)


def test_blocks_find_what_centres_miss(spark):
    """A chain of sets in one bucket, of which the centre reaches few."""
    chain = [np.arange(n * 6, n * 6 + 100, dtype=np.uint64) for n in range(12)]
    rows = [(1, 0, 0, n, n, s.tobytes()) for n, s in enumerate(chain)]
    schema = "key long, block int, chunk int, id long, component long, shingles binary"
    frame = spark.createDataFrame(rows, schema)
    links = M.confirm_blocks(frame, frame, 85)
    found = {tuple(r) for r in links.collect()}
    assert {(n, n + 1) for n in range(11)} <= found
    assert all(abs(a - b) == 1 for a, b in found)


def test_signature_agreement_estimates_similarity():
    random = np.random.default_rng(5)
    for size, common in ((1000, 500), (300, 240), (40, 30), (6, 5)):
        agree = []
        for _ in range(40):
            pool = np.unique(random.integers(0, 1 << 63, 3 * size, dtype=np.uint64))
            random.shuffle(pool)
            one, two = np.sort(pool[:size]), np.sort(pool[size - common : 2 * size - common])
            agree.append(np.mean(M.signature(one) == M.signature(two)))
        assert abs(np.mean(agree) - common / (2 * size - common)) < 0.08


def test_words_and_shingles_of_the_contract():
    texts = pa.array(["A b\x0bC\x0cD  E", "a B c d e", "a b c d", "", None, "a b É é"])
    sets = list(M.shingle_sets(texts))
    assert sets[0].tolist() == sets[1].tolist()
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 1]
    assert sets[2].tolist() != sets[0].tolist()


def test_components(spark):
    pairs = [(n + 1, n) for n in range(40)] + [(100, 101), (103, 102), (101, 103), (7, 7)]
    links = spark.createDataFrame(pairs, "a long, b long")
    found = {r.id: r.component for r in components(links).collect()}
    assert found == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 104)}
    assert components(links.limit(0)).count() == 0


def test_odd_rows(odd, empty):
    rows = M.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 1)}
    assert all(by_id[n].n_shingles == 0 and by_id[n].kept for n in (2, 3, 4))
    assert by_id[9].component_id == 1 and not by_id[9].kept
    assert sum(r.doc_id == 1 and r.kept for r in rows) == 3
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert M.near_duplicates(empty).count() == 0
