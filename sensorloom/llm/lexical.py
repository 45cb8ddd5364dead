"""Ranked lexical search over a length-stratified index.

A document's normaliser m follows from its length alone. Each shard of the index numbers its
documents by m, so that documents of equal m, a stratum, are neighbours, and keeps the postings of
a term by stratum, then by descending term frequency. What a term adds to a score depends only on
stratum and frequency, so it is computed once for each frequency of a stratum; the first posting of
a stratum bounds what the term can add there. A query visits the strata of a shard in the order of
the sums of these bounds, and stops where no document can reach its list any more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored
from .hashing import text_bytes, word_hashes, word_spans

TOP = 50
SLICE_BYTES = 1 << 20
# Postings of a shard (terms of documents, once each); a document is never divided.
SHARD_POSTINGS = 1 << 20
# Items are searched in blocks with about so many characters; their terms go to every task.
BLOCK_CHARS = 1 << 20
# Documents of the strata that are visited first, before the rest is held against what they gave.
FIRST_DOCS = 256

IS_BLANK = np.ones(256, dtype=bool)
IS_BLANK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_LENGTHS_DDL = "docs long, terms long"
_SHARDS_DDL = (
    "doc_ids array<long>, postings long, strata binary, stratum_docs binary, terms binary, "
    "term_postings binary, docs binary, tfs binary"
)
_DF_DDL = "term long, df long"
_HITS_DDL = "item int, item_id long, doc_id long, score long"
_RANKED_DDL = "item_id long, rank int, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).max


@dataclass
class Index:
    """Stored shards, the number of documents with a term, and the number of their terms."""

    shards: DataFrame
    docs: int
    terms: int


def normaliser(n: int, docs: int, terms: int) -> int:
    return 100 - 50 + (50 * n * docs) // terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for part in slices(batch, 0, SLICE_BYTES):
            first = word_spans(*text_bytes(part.column(0)), IS_BLANK)[2]
            docs += int(np.count_nonzero(np.diff(first)))
            terms += int(first[-1])
    yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all terms of all documents.

    Texts are read twice, once for the lengths, and not shuffled; a shard is what a task reads
    until it has ``SHARD_POSTINGS``, stored as one row of flat arrays.
    """
    texts = _texts(docs, id_col, text_col)
    total = texts.select("text").mapInArrow(_lengths, _LENGTHS_DDL)
    n_docs, n_terms = total.agg(
        F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))
    ).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                shard.add(part)
                if shard.postings >= SHARD_POSTINGS:
                    yield shard.row(n_docs, n_terms)
                    shard = _Shard()
        if shard.postings:
            yield shard.row(n_docs, n_terms)

    return Index(stored(texts.mapInArrow(run, _SHARDS_DDL), "strata"), n_docs, n_terms)


@dataclass
class _Shard:
    """Documents of a shard while it is gathered."""

    ids: list[np.ndarray] = field(default_factory=list)
    lengths: list[np.ndarray] = field(default_factory=list)
    docs: list[np.ndarray] = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)
    tfs: list[np.ndarray] = field(default_factory=list)
    postings: int = 0
    n_docs: int = 0

    def add(self, part: pa.RecordBatch) -> None:
        hashes, _, _, first = word_hashes(*text_bytes(part.column(1)), IS_BLANK)
        n = np.diff(first)
        doc = np.repeat(np.cumsum(n > 0) - 1, n)  # only documents with a term are numbered
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        ids = pc.fill_null(part.column(0), _NO_ID).to_numpy()
        self.ids.append(ids[n > 0])
        self.lengths.append(n[n > 0])
        self.docs.append(doc[at] + self.n_docs)
        self.terms.append(hashes[at])
        self.tfs.append(np.diff(np.append(at, len(doc))))
        self.postings += len(at)
        self.n_docs += int(np.count_nonzero(n))

    def row(self, n_docs: int, n_terms: int) -> pa.RecordBatch:
        """The shard's row: documents by m and id, postings by term, m, falling tf and document."""
        ids, lengths, doc, term, tf = map(
            np.concatenate, (self.ids, self.lengths, self.docs, self.terms, self.tfs)
        )
        own, place = np.unique(lengths, return_inverse=True)
        m = np.array([normaliser(n, n_docs, n_terms) for n in own.tolist()])[place]
        order = np.lexsort((ids, m))
        ids, m = ids[order], m[order]
        strata, stratum_docs, stratum = np.unique(m, return_index=True, return_inverse=True)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        doc = number[doc]
        order = np.lexsort((doc, -tf, stratum[doc], term))
        terms, term_postings = np.unique(term[order], return_index=True)
        arrays = {
            "strata": strata.astype("<i8"),
            "stratum_docs": stratum_docs.astype("<i4"),
            "terms": terms.astype("<u8"),
            "term_postings": term_postings.astype("<i4"),
            "docs": _narrow(doc[order]),
            "tfs": _narrow(tf[order]),
        }
        doc_ids = pa.array([pa.array(ids, mask=ids == _NO_ID)], pa.list_(pa.int64()))
        postings = pa.array([len(doc)], pa.int64())
        return pa.RecordBatch.from_arrays(
            [doc_ids, postings, *(pa.array([a.tobytes()], pa.binary()) for a in arrays.values())],
            names=["doc_ids", "postings", *arrays],
        )


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in as few bytes as the largest one needs."""
    for kind in ("<u1", "<u2", "<u4"):
        if values.max(initial=0) <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype("<u8")


def _widen(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=f"<u{len(packed) // count}").astype(np.int64)


@dataclass
class _Query:
    """The items of a block: distinct terms, ascending, and the id and the terms of each item."""

    terms: np.ndarray
    ids: list[int | None]
    items: list[np.ndarray]
    weights: np.ndarray | None = None


def _queries(rows: list[tuple[int | None, str]]) -> _Query:
    ids, texts = zip(*rows)
    hashes, _, _, first = word_hashes(*text_bytes(pa.array(texts, pa.string())), IS_BLANK)
    terms = np.unique(hashes)
    place = np.searchsorted(terms, hashes)
    items = [np.unique(place[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return _Query(terms, list(ids), items)


def search(
    index: Index,
    items: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` documents of each item with a score above 0.

    Terms are the maximal runs of digits, letters and non-ASCII characters, with A-Z lower-cased,
    and compared by 64-bit hashes. A document scores for each different term of the item the
    term's weight times its impact (``weight``, ``impact``, ``normaliser``). Highest scores come
    first, equal ones by ascending doc_id, documents without an id last.

    Each row of the documents and each row of ``items`` counts for itself, also where rows are
    equal or share an id. Null texts, and texts without a term, rank nothing and are never found;
    very long texts are shards or blocks of their own; other columns are ignored; empty tables
    give no rows.

    Items go in blocks of bounded size to every task; each task returns ``top`` documents of each
    item at most.
    """
    spark = items.sparkSession
    rows = items.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")
    ).where("text is not null")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    result = spark.createDataFrame([], _RANKED_DDL)
    for n in range(blocks):
        own = [(r.item_id, r.text) for r in rows.where(block == n).collect()]
        if own:
            query = _queries(own)
            _weigh(index, query)
            result = result.unionByName(_top(index, spark.sparkContext.broadcast(query), top))
    return result


def _weigh(index: Index, query: _Query) -> None:
    """Sets the weight of each term of a block, from the numbers of documents that hold them."""
    wanted = index.shards.sparkSession.sparkContext.broadcast(query.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted.value), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                terms, begins, postings = (batch.column(c)[row].as_py() for c in range(3))
                begins = np.frombuffer(begins, dtype="<i4")
                ends = np.append(begins[1:], postings)
                at, here = _present(np.frombuffer(terms, dtype="<u8"), wanted.value)
                df[here] += (ends - begins)[at]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    shards = index.shards.select("terms", "term_postings", "postings")
    counted = shards.mapInArrow(run, _DF_DDL).groupBy("term").agg(F.sum("df").alias("df"))
    query.weights = np.zeros(len(query.terms), dtype=np.int64)
    for row in counted.collect():  # at most one for each term of the block
        query.weights[row.term] = weight(row.df, index.docs)


def _present(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``terms`` of those of ``wanted`` that are there, and their places in ``wanted``."""
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    here = np.flatnonzero(terms[at] == wanted)
    return at[here], here


def _top(index: Index, query: Broadcast, top: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = query.value
        best = [_Best(top) for _ in own.items]
        for batch in batches:
            for row in range(batch.num_rows):
                shard = _Opened({c: batch.column(c)[row] for c in batch.schema.names}, own)
                for terms, found in zip(own.items, best):
                    shard.search(terms, found)
        for item, found in enumerate(best):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.ids), item, dtype=np.int32)),
                        pa.array([own.ids[item]] * len(found.ids), pa.int64()),
                        pa.array(found.ids, mask=found.ids == _NO_ID),
                        pa.array(found.scores),
                    ],
                    names=["item", "item_id", "doc_id", "score"],
                )

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    hits = index.shards.mapInArrow(run, _HITS_DDL)
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


class _Best:
    """The best documents of an item so far."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.ids = np.zeros(0, dtype=np.int64)
        self.scores = np.zeros(0, dtype=np.int64)

    @property
    def least(self) -> int:
        """A score below this one cannot come into the list."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(scores) > 2 * self.top:  # the last score that counts, then all that reach it
            reach = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            ids, scores = ids[scores >= reach], scores[scores >= reach]
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[: self.top]
        self.ids, self.scores = ids[order], scores[order]


class _Opened:
    """A shard's postings of the terms of a block, with what each adds to a score."""

    def __init__(self, row: dict[str, pa.Scalar], query: _Query) -> None:
        ids = row["doc_ids"].values
        self.ids = pc.fill_null(ids, _NO_ID).to_numpy()
        m = np.frombuffer(row["strata"].as_py(), dtype="<i8")
        first = np.frombuffer(row["stratum_docs"].as_py(), dtype="<i4")
        self.stratum_docs = np.diff(np.append(first, len(self.ids)))
        stratum_of = np.repeat(np.arange(len(m)), self.stratum_docs)
        terms = np.frombuffer(row["terms"].as_py(), dtype="<u8")
        begins = np.frombuffer(row["term_postings"].as_py(), dtype="<i4").astype(np.int64)
        count = row["postings"].as_py()
        docs, tfs = (_widen(row[c].as_py(), count) for c in ("docs", "tfs"))
        at, here = _present(terms, query.terms)
        sizes = np.append(begins[1:], count)[at] - begins[at]
        postings = _spread(begins[at], sizes)
        self.docs, tfs = docs[postings], tfs[postings]
        term = np.repeat(np.arange(len(here)), sizes)
        stratum = stratum_of[self.docs]
        # Impacts: once for each frequency of a term in a stratum.
        in_stratum = _borders(term, stratum)
        once = np.flatnonzero(_borders(term, stratum, tfs))
        added = query.weights[here][term[once]] * impact(tfs[once], m[stratum[once]])
        self.added = np.repeat(added, np.diff(np.append(once, len(tfs))))
        # Postings of a term in a stratum, of which the first adds most.
        self.begin = np.flatnonzero(in_stratum)
        self.size = np.diff(np.append(self.begin, len(tfs)))
        self.stratum, self.most = stratum[self.begin], self.added[self.begin]
        self.term_at = np.full(len(query.terms), -1)
        self.term_at[here] = np.arange(len(here))
        self.term_groups = np.searchsorted(term[self.begin], np.arange(len(here) + 1))

    def search(self, terms: np.ndarray, found: _Best) -> None:
        """Brings the documents of this shard into the list of an item."""
        own = self.term_at[terms]
        own = own[own >= 0]
        if not len(own):
            return
        first = self.term_groups[own]
        groups = _spread(first, self.term_groups[own + 1] - first)
        stratum = self.stratum[groups]
        bounds = np.zeros(len(self.stratum_docs), dtype=np.int64)
        np.add.at(bounds, stratum, self.most[groups])
        order = np.argsort(-bounds, kind="stable")
        begin = 0
        while begin < len(order):
            # A document with as much as the last one of the list still counts, if its id is less.
            reach = begin + int(np.searchsorted(-bounds[order[begin:]], -found.least, side="right"))
            if reach == begin:
                return
            docs = np.cumsum(self.stratum_docs[order[begin:reach]])
            limit = len(self.ids) if begin else FIRST_DOCS
            end = min(begin + int(np.searchsorted(docs, limit)) + 1, reach)
            self._visit(groups, stratum, order[begin:end], found)
            begin = end

    def _visit(
        self, groups: np.ndarray, stratum: np.ndarray, visited: np.ndarray, found: _Best
    ) -> None:
        now = np.zeros(len(self.stratum_docs), dtype=bool)
        now[visited] = True
        groups = groups[now[stratum]]
        postings = _spread(self.begin[groups], self.size[groups])
        scores = np.zeros(len(self.ids), dtype=np.int64)
        np.add.at(scores, self.docs[postings], self.added[postings])
        docs = np.flatnonzero(scores >= found.least)
        if len(docs):
            found.add(self.ids[docs], scores[docs])


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of spans, one behind the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begins - before, sizes)


def _borders(*columns: np.ndarray) -> np.ndarray:
    """Where one of the columns differs from the row before."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = False
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out
