"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are sequences of words. A CGK random walk reads a window of words and repeats or advances at
each step as a random bit of the word under it says; two windows at a small edit distance then
agree in most steps. Sampled steps are the keys of a locality-sensitive hash: windows as long as a
benchmark item that share a key with it in one of many repetitions are candidates.

What is looked for is a span of any length within the edit distance of an item. The window that
starts where such a span does may end with words behind it, where the span has lost words, or
beyond the end of the text. So steps are sampled only as far as the walk is expected to stay within
the shortest span, and a candidate is verified over all spans around its window.

Before the walk, windows that hold too few word pairs of the items of their length are left out:
an edit of one word changes at most two pairs, or one and the last word of the window, so no window
that starts with a span within the distance is lost.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, slices
from .hashing import prefix, spans, text_bytes

EDIT_RATE = 0.2  # edits allowed for each word of an item
MIN_WORDS = 5
SAMPLED_STEPS = 2
TARGET_RECALL = 0.99
MAX_REPETITIONS = 256
# Repetitions are set from so many edited copies of items, windows of each, and tried keys.
COPIES = 24
WINDOWS = 8
TRIES = 48
# Items are used in blocks of about so many characters; each block is one pass over the documents.
BLOCK_CHARS = 8_000_000
# Text that a task searches at a time.
SLICE_BYTES = 1 << 20

_TABLE_BITS = 20
_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[48:58] = _WORD_BYTE[97:123] = True
_WORD_BYTE[128:] = True
_PAIR = np.uint64(0x9FB21C651E98DF25)
_PAD = np.uint64(0)  # stands behind the last word, of items and texts
_OUTSIDE = np.uint64(1)  # stands for no word at all

MATCHES_DDL = "doc_id long, item_id long, word_start long, n_words long, distance long"


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (runs of letters, digits and bytes beyond ASCII) of all
    texts, and the border of each text."""
    data, borders = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    inside = _WORD_BYTE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[borders] = True
    before = np.concatenate([[False], inside])[:-1] & ~edge[:-1]
    after = np.concatenate([inside, [False]])[1:] & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return mix64(spans(prefix(data), starts, ends)), np.searchsorted(starts, borders)


def allowed(n_words: int) -> int:
    return int(EDIT_RATE * n_words)


def word_pairs(words: np.ndarray) -> np.ndarray:
    return mix64(words[:-1] * _PAIR + words[1:])


def best_span(item: list[int], text: list[int]) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any span of ``text``, and the span: start and end.

    Of spans at that distance the first to end counts, and of those the shortest.
    """
    scores = _ending_scores(item, text)
    distance = min(scores)
    end = scores.index(distance)
    back = _ending_scores(item[::-1], text[:end][::-1], free=False)
    return distance, end - back.index(distance), end


def _ending_scores(item: list[int], text: list[int], free: bool = True) -> list[int]:
    """For each end in ``text`` the least distance of ``item`` to a span that ends there, and with
    ``free`` starts anywhere, else at the beginning. By Myers' bit vectors."""
    at: dict[int, int] = defaultdict(int)
    for n, word in enumerate(item):
        at[word] |= 1 << n
    full, last = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = full, 0, len(item)
    scores = [score]
    for word in text:
        match = at.get(word, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        more = (down | ~(diagonal | up)) & full
        less = up & diagonal
        score += bool(more & last) - bool(less & last)
        scores.append(score)
        more = (more << 1 | (not free)) & full
        less = (less << 1) & full
        up = (less | ~(diagonal | more)) & full
        down = more & diagonal
    return scores


def best_spans(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_span`` of each row of ``items`` in the same row of ``texts``, all rows at once for
    items of up to 64 words."""
    if items.shape[1] > 64:
        found = [best_span(a, b) for a, b in zip(items.tolist(), texts.tolist())]
        return tuple(np.array(found, dtype=np.int64).reshape(-1, 3).T)
    scores = _all_ending_scores(items, texts, True)
    end = scores.argmin(axis=1)
    rows = np.arange(len(items))
    distance = scores[rows, end]
    width = texts.shape[1]
    turned = end[:, None] - 1 - np.arange(width)
    before = np.where(turned >= 0, texts[rows[:, None], np.maximum(turned, 0)], _OUTSIDE)
    back = _all_ending_scores(items[:, ::-1], before, False)
    return distance, end - (back == distance[:, None]).argmax(axis=1), end


def _all_ending_scores(items: np.ndarray, texts: np.ndarray, free: bool) -> np.ndarray:
    """``_ending_scores`` of all rows at once."""
    count, length = items.shape
    bits = np.uint64(1) << np.arange(length, dtype=np.uint64)
    full = np.bitwise_or.reduce(bits)
    last, one = np.uint64(length - 1), np.uint64(1)
    up, down = np.full(count, full), np.zeros(count, dtype=np.uint64)
    scores = np.full((count, texts.shape[1] + 1), length, dtype=np.int64)
    for step in range(texts.shape[1]):
        match = np.where(items == texts[:, step, None], bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        more = (down | ~(diagonal | up)) & full
        less = up & diagonal
        change = ((more >> last) & one).view(np.int64) - ((less >> last) & one).view(np.int64)
        scores[:, step + 1] = scores[:, step] + change
        more = (more << one | np.uint64(not free)) & full
        less = (less << one) & full
        up = (less | ~(diagonal | more)) & full
        down = more & diagonal
    return scores


@dataclass
class Index:
    """Everything a task needs to search one block of items."""

    repetitions: dict[int, int] = field(default_factory=dict)  # for each length; 0: no walk
    lengths: list[int] = field(default_factory=list)
    pair_classes: np.ndarray | None = None  # for each pair hash the lengths that hold it, as bits
    keys: np.ndarray | None = None
    key_items: list[list[int]] = field(default_factory=list)
    items: list[tuple[int, list[int]]] = field(default_factory=list)
    of_length: dict[int, list[int]] = field(default_factory=dict)


def _salts(length: int, repetitions: int) -> np.ndarray:
    steps = np.arange(3 * length * repetitions, dtype=np.uint64).reshape(repetitions, -1)
    return mix64(steps + np.uint64(length << 32)) | np.uint64(1)


def _steps(length: int, repetition: int) -> np.ndarray:
    """The sampled steps of a repetition, ascending. A walk advances by a word in two steps, so
    these are steps on the words that even the shortest span within the distance has."""
    random = np.random.default_rng((length, repetition))
    reach = 2 * (length - allowed(length))
    return np.sort(random.choice(reach, SAMPLED_STEPS, replace=False))


def walk_keys(windows: np.ndarray, repetitions: int) -> np.ndarray:
    """The key of each window (rows of word hashes) in each repetition, by a CGK walk.

    All windows walk in all repetitions at once, a step at a time.
    """
    count, length = windows.shape
    if not repetitions:
        return np.zeros((count, 0), dtype=np.uint64)
    padded = np.concatenate([windows, np.full((count, 1), _PAD)], axis=1).ravel()
    base = np.arange(count, dtype=np.int64)[None, :] * (length + 1)
    salts = _salts(length, repetitions)
    sampled = np.array([_steps(length, r) for r in range(repetitions)])
    place = np.zeros((repetitions, count), dtype=np.int64)
    seeds = np.arange(repetitions, dtype=np.uint64) + np.uint64(length << 16)
    keys = np.repeat(mix64(seeds)[:, None], count, axis=1)
    for step in range(int(sampled.max()) + 1):
        words = padded[base + place]
        here = np.flatnonzero((sampled == step).any(axis=1))
        if len(here):
            keys[here] = mix64(keys[here] ^ words[here])
        place += ((words * salts[:, step, None]) >> np.uint64(63)).view(np.int64)
        np.minimum(place, length, out=place)
    return keys.T


def edited_copy(words: list, edits: int, kind: str, random: np.random.Generator, new) -> list:
    """``words`` with a number of random edits: changed, inserted, deleted or mixed ones."""
    out = list(words)
    for _ in range(edits):
        own = kind if kind != "mixed" else ("changed", "inserted", "deleted")[random.integers(3)]
        n = int(random.integers(len(out)))
        if own == "changed":
            out[n] = new(random)
        elif own == "inserted":
            out.insert(n, new(random))
        elif len(out) > 1:
            del out[n]
    return out


KINDS = ("changed", "inserted", "deleted", "mixed")


def repetitions_for(items: list[np.ndarray]) -> int:
    """Repetitions that find a span at the largest allowed distance of an item with the target
    recall, for items of one length; 0 if that takes more than ``MAX_REPETITIONS``.

    They follow from the rate at which edited copies of the items, set in foreign words, are found
    in one repetition, by any of the windows around the copy that hold enough of the item's pairs;
    the kind of edit that is found least decides.
    """
    length, most = len(items[0]), allowed(len(items[0]))
    if not most:
        return 1  # equal windows share every key
    random = np.random.default_rng(length)

    def new(r: np.random.Generator) -> np.uint64:
        return np.uint64(r.integers(2, 1 << 62))

    chosen = items[:: -(-len(items) // COPIES)]
    keys = walk_keys(np.array(chosen, dtype=np.uint64), TRIES)
    pairs = [np.unique(word_pairs(words)) for words in chosen]
    missed = []
    for kind in KINDS:
        windows, copy_of = [], []
        for copy in range(COPIES):
            words = chosen[copy % len(chosen)]
            span = edited_copy(words.tolist(), most, kind, random, new)
            foreign = [new(random) for _ in range(most + length + most)]
            text = np.array([*foreign[:most], *span, *foreign[most:]], dtype=np.uint64)
            held = np.isin(word_pairs(text), pairs[copy % len(chosen)])
            held = np.convolve(held, np.ones(length - 1, dtype=np.int64), "valid")
            near = np.flatnonzero(held[: 2 * most + 1] >= needed_pairs(length))
            near = near[:: -(-len(near) // WINDOWS)]
            windows += [text[n : n + length] for n in near.tolist()]
            copy_of += [copy] * len(near)
        copy_of = np.array(copy_of)
        own = keys[copy_of % len(chosen)] == walk_keys(np.array(windows), TRIES)
        found = np.zeros((COPIES, TRIES), dtype=bool)
        np.logical_or.at(found, copy_of, own)
        # Copies differ in how easily they are found: what counts is how many are missed in all.
        missed.append(1 - np.clip(found.mean(axis=1), 1 / (2 * TRIES), 1 - 1 / (2 * TRIES)))
    for repetitions in range(1, MAX_REPETITIONS + 1):
        if all((m**repetitions).mean() <= 1 - TARGET_RECALL for m in missed):
            return repetitions
    return 0


def needed_pairs(length: int) -> int:
    """Pairs of an item that a window at the start of a span within the distance has at least."""
    return max(1, length - 1 - 2 * allowed(length))


def build_index(rows: list[tuple[int, str]]) -> Index:
    index = Index()
    words, borders = word_ids(pa.array([t or "" for _, t in rows], pa.string()))
    found = [
        (item, words[a:b])
        for (item, _), a, b in zip(rows, borders[:-1], borders[1:])
        if b - a >= MIN_WORDS
    ]
    if not found:
        return index
    index.items = [(item, own.tolist()) for item, own in found]
    index.lengths = sorted({len(own) for _, own in found})
    index.pair_classes = np.zeros(
        (1 << _TABLE_BITS, -(-len(index.lengths) // 64)), dtype=np.uint64
    )
    buckets: dict[int, set[int]] = defaultdict(set)
    for _, own in found:
        group, bit = divmod(index.lengths.index(len(own)), 64)
        slots = word_pairs(own) >> np.uint64(64 - _TABLE_BITS)
        index.pair_classes[slots, group] |= np.uint64(1 << bit)
    for length in index.lengths:
        numbers = [n for n, (_, own) in enumerate(found) if len(own) == length]
        index.of_length[length] = numbers
        index.repetitions[length] = repetitions_for([found[n][1] for n in numbers])
        keys = walk_keys(np.array([found[n][1] for n in numbers]), index.repetitions[length])
        for number, own_keys in zip(numbers, keys.tolist()):
            for key in own_keys:
                buckets[key].add(number)
    index.keys = np.array(sorted(buckets), dtype=np.uint64)
    index.key_items = [sorted(buckets[k]) for k in index.keys.tolist()]
    return index


def _likely_windows(
    words: np.ndarray, borders: np.ndarray, index: Index
) -> Iterator[tuple[int, np.ndarray]]:
    """For each item length the starts of windows that hold enough pairs of items of that length.
    Windows may reach beyond the end of their text by the allowed edits."""
    classes = index.pair_classes[word_pairs(words) >> np.uint64(64 - _TABLE_BITS)]
    inner = borders[(borders > 0) & (borders < len(words))]
    classes[inner - 1] = 0  # pairs across two texts
    for n, length in enumerate(index.lengths):
        group, bit = divmod(n, 64)
        if bit == 0:
            present = np.flatnonzero(classes[:, group])
            held = classes[present, group]
        hits = present[(held & np.uint64(1 << bit)) != 0]
        need = needed_pairs(length)
        if len(hits) < need:
            continue
        first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
        near = last - first <= length - 2
        change = np.zeros(len(words) + 2, dtype=np.int32)
        low = np.maximum(last[near] - (length - 2), 0)
        np.add.at(change, low, 1)
        np.add.at(change, first[near] + 1, -1)
        starts = np.flatnonzero(np.cumsum(change[: len(words)]) > 0)
        text = np.searchsorted(borders, starts, side="right")
        end = borders[np.minimum(text, len(borders) - 1)]
        starts = starts[starts + length - allowed(length) <= end]
        if len(starts):
            yield length, starts


class Search:
    """Finds the items of an index in texts that are added in parts.

    Likely windows are held back until there are many of one length, since a walk takes as many
    steps for one window as for thousands.
    """

    HELD = 8192

    def __init__(self, index: Index):
        self.index = index
        self.texts = 0
        self.held: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        self.found: dict[tuple[int, int], set[tuple[int, int, int]]] = defaultdict(set)

    def add(self, words: np.ndarray, borders: np.ndarray) -> None:
        """The next texts, as ``word_ids`` gives them."""
        if self.index.items and len(words) > 1:
            for length, starts in _likely_windows(words, borders, self.index):
                text = np.searchsorted(borders, starts, side="right") - 1
                for begin in range(0, len(starts), self.HELD):
                    own = slice(begin, begin + self.HELD)
                    around = _around(words, borders, starts[own], text[own], length)
                    place = starts[own] - borders[text[own]]
                    self.held[length].append((text[own] + self.texts, place, around))
                    if sum(len(h[0]) for h in self.held[length]) >= self.HELD:
                        self._walk(length)
        self.texts += len(borders) - 1

    def _walk(self, length: int) -> None:
        texts, places, around = map(np.concatenate, zip(*self.held.pop(length)))
        index, most = self.index, allowed(length)
        windows = np.where(around == _OUTSIDE, _PAD, around)[:, most : most + length]
        if index.repetitions[length]:
            keys = walk_keys(windows, index.repetitions[length])
            at = np.minimum(np.searchsorted(index.keys, keys), len(index.keys) - 1)
            row, repetition = np.nonzero(index.keys[at] == keys)
            pairs = {
                (r, number)
                for r, k in zip(row.tolist(), at[row, repetition].tolist())
                for number in index.key_items[k]
                if len(index.items[number][1]) == length
            }
        else:  # keys would miss too much: every likely window is verified
            pairs = {(r, n) for r in range(len(windows)) for n in index.of_length[length]}
        pairs = sorted(pairs)
        for begin in range(0, len(pairs), self.HELD):
            rows, numbers = map(list, zip(*pairs[begin : begin + self.HELD]))
            items = np.array([index.items[n][1] for n in numbers], dtype=np.uint64)
            distance, start, end = best_spans(items, around[rows])
            for n in np.flatnonzero(distance <= most).tolist():
                place = int(places[rows[n]]) - most + int(start[n])
                span = (int(distance[n]), place, int(end[n] - start[n]))
                self.found[int(texts[rows[n]]), numbers[n]].add(span)

    def matches(self) -> list[tuple]:
        """(text number, item, start word in the text, words, distance) of every match so far.

        Of spans of one text that match one item and start less than its length apart, the nearest
        counts, then the first.
        """
        for length in list(self.held):
            self._walk(length)
        matches = []
        for (text, number), spans_found in self.found.items():
            item, own = self.index.items[number]
            length = len(own)
            taken: dict[int, int] = {}  # by start // length, of which each holds one at most
            for distance, start, width in sorted(spans_found):
                block = start // length
                near = (taken.get(b) for b in (block - 1, block, block + 1))
                if all(t is None or abs(start - t) >= length for t in near):
                    taken[block] = start
                    matches.append((text, item, start, width, distance))
        return sorted(matches, key=lambda m: (m[0], m[1] is None, m[1] or 0, *m[2:]))


def _around(
    words: np.ndarray, borders: np.ndarray, starts: np.ndarray, text: np.ndarray, length: int
) -> np.ndarray:
    """The words of windows, with the allowed number of words before and behind; ``_OUTSIDE`` where
    the text has none."""
    most = allowed(length)
    at = starts[:, None] + np.arange(-most, length + most)
    inside = (at >= borders[text][:, None]) & (at < borders[text + 1][:, None])
    return np.where(inside, words[np.clip(at, 0, len(words) - 1)], _OUTSIDE)


def search(texts: pa.RecordBatch, column: int, index: Index) -> list[tuple]:
    """The matches of a batch; the text number is that of its row."""
    found = Search(index)
    for part in slices(texts, column, SLICE_BYTES):
        found.add(*word_ids(part.column(column)))
    return found.matches()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per place where a document holds a benchmark item: doc_id, item_id, word_start,
    n_words, distance.

    A place is a span of words, of any length, with a word edit distance of at most ``EDIT_RATE`` of
    the item's words; case, punctuation and spacing do not count. A span at exactly the largest
    distance is found with probability ``TARGET_RECALL`` or more, nearer ones with more; what is
    returned is verified exactly.

    The items are used in blocks of bounded size that go to every task; the documents are read
    once per block and never shuffled. Null and empty texts hold nothing; items that are null or
    shorter than ``MIN_WORDS`` words are never found; equal documents and equal items all give
    their own rows; other columns are ignored; empty tables give no rows.
    """
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    result = docs.limit(0).mapInArrow(lambda batches: iter(()), MATCHES_DDL)
    for index in _blocks(benchmark, item_col, item_text_col):
        result = result.unionByName(_matches(docs, index))
    return result


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns. Cases are
    defined as in ``contaminated``; rows with a null text or id stay."""
    for index in _blocks(benchmark, item_col, item_text_col):
        docs = _without_matches(docs, text_col, index)
    return docs


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Broadcast]:
    """Indexes over parts of the items of about ``BLOCK_CHARS`` characters each."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = math.ceil(chars / BLOCK_CHARS)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for n in range(blocks):
        rows = [(r.item_id, r.text) for r in items.where(block == n).collect() if r.text]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield benchmark.sparkSession.sparkContext.broadcast(build_index(rows))


def _matches(docs: DataFrame, index: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = search(batch, 1, index.value)
            if found:
                columns = zip(*((ids[m[0]], *m[1:]) for m in found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "item_id", "word_start", "n_words", "distance"],
                )

    return docs.mapInArrow(run, MATCHES_DDL)


def _without_matches(docs: DataFrame, text_col: str, index: Broadcast) -> DataFrame:
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[m[0] for m in search(batch, at, index.value)]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
