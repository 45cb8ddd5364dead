"""Periodic runs of words, by block convolution.

A run of period q and at least four times that many words holds, for the power of two B with
B <= q < 2 B, a whole block of B words (blocks start at multiples of B) and the same words again q
further on. So at every scale B each block is compared with the window of 2 B words that starts B
further on: the sums of squared differences of word numbers at all B shifts are one convolution,
made exactly by integers modulo a prime. Where a sum is zero the block recurs, and the distance
seeds a run, which is then extended word by word on both sides.

All texts of a slice lie one behind the other with a number of its own between them, so blocks of
many documents are transformed together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .ntt import PRIME, squared_differences

MIN_LENGTH = 6
MIN_PERIODS = 4
SLICE_BYTES = 1 << 20
# Places that are transformed, or compared, at a time.
CHUNK = 1 << 18

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS_DDL = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and smallest period of every run in an array of word numbers (not negative, below
    the prime), ascending by start, then period."""
    ends = _next_same(words)
    found: list[np.ndarray] = []
    width = 1
    while MIN_PERIODS * width <= len(words):
        seeds = _seeds(words, ends, width)
        if len(seeds):
            found.append(_extend(words, width, seeds))
        width *= 2
    empty = np.zeros(0, dtype=np.int64)
    if not found:
        return empty, empty, empty
    start, end, period = np.concatenate(found, axis=1)
    long_enough = end - start >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
    start, end, period = start[long_enough], end[long_enough], period[long_enough]
    # A stretch with a period that is a multiple of its smallest one is found at both.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _next_same(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of occurrences of each word, and (word, place) keys in order, to ask whether a word
    stands in some span."""
    counts = np.bincount(words)[words] if len(words) else words
    keys = np.sort(words * len(words) + np.arange(len(words)))
    return counts, keys, words


def _seeds(words: np.ndarray, known: tuple, width: int) -> np.ndarray:
    """(block, distance) of blocks that recur at a distance of width to 2 width - 1.

    Blocks whose rarest word does not stand where it would have to are not transformed: such a
    block has no shift without a mismatch.
    """
    counts, keys, _ = known
    blocks = len(words) // width
    rarest = np.argmin(counts[: blocks * width].reshape(blocks, width), axis=1)
    place = rarest + np.arange(blocks) * width
    low = words[place] * len(words) + np.minimum(place + width, len(words))
    high = words[place] * len(words) + np.minimum(place + 2 * width, len(words))
    likely = np.flatnonzero(np.searchsorted(keys, high) > np.searchsorted(keys, low))
    out = []
    padded = np.concatenate([words, np.full(3 * width, PRIME - 1, dtype=words.dtype)])
    rows = max(1, CHUNK // (2 * width))
    for begin in range(0, len(likely), rows):
        part = likely[begin : begin + rows]
        at = part[:, None] * width + np.arange(3 * width)
        spans = padded[at].astype(np.uint64)
        block, shift = np.nonzero(squared_differences(spans[:, :width], spans[:, width:]) == 0)
        out.append(np.column_stack([part[block], shift + width]))
    seeds = np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
    # A shift at which the sum is a multiple of the prime without being zero, or that reaches past
    # the end, is told by its words.
    return seeds[_holds(words, seeds[:, 0] * width, seeds[:, 1], width)]


def _holds(words: np.ndarray, start: np.ndarray, distance: np.ndarray, width: int) -> np.ndarray:
    """Whether the block of ``width`` words at each start recurs at the distance."""
    out = start + distance + width <= len(words)
    rows = max(1, CHUNK // width)
    for begin in range(0, len(start), rows):
        part = np.flatnonzero(out[begin : begin + rows]) + begin
        at = start[part, None] + np.arange(width)
        out[part] = (words[at] == words[at + distance[part, None]]).all(axis=1)
    return out


def _extend(words: np.ndarray, width: int, seeds: np.ndarray) -> np.ndarray:
    """start, end (exclusive) and period of the stretches around seeds. Neighbouring blocks with one
    distance are one chain; the block before and the one behind a chain mismatch somewhere, so
    both sides are settled within a block."""
    block, distance = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))].T
    new = np.ones(len(block), dtype=bool)
    new[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + 1)
    last = np.append(np.flatnonzero(new)[1:] - 1, len(block) - 1)
    first, behind, distance = block[new] * width, (block[last] + 1) * width, distance[new]
    before = _same_words(words, first - 1, distance, width, -1)
    after = _same_words(words, behind, distance, width, 1)
    return np.stack([first - before, behind + after + distance, distance])


def _same_words(
    words: np.ndarray, place: np.ndarray, distance: np.ndarray, width: int, step: int
) -> np.ndarray:
    """How many places from each one on, in the direction of ``step`` and at most ``width``, hold
    the word that stands at the distance behind them."""
    out = np.zeros(len(place), dtype=np.int64)
    rows = max(1, CHUNK // width)
    for begin in range(0, len(place), rows):
        own, far = place[begin : begin + rows, None], distance[begin : begin + rows, None]
        at = own + step * np.arange(width)
        inside = (at >= 0) & (at + far < len(words))
        at = np.where(inside, at, 0)
        differs = ~inside | (words[at] != words[np.where(inside, at + far, 0)])
        some = differs.any(axis=1)
        out[begin : begin + rows] = np.where(some, differs.argmax(axis=1), width)
    return out


def _numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and the border of each text among them."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words, offsets = split.flatten(), np.asarray(split.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    full = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(np.asarray(full, dtype=np.int64))])
    return words.filter(full), kept[offsets]


def runs_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Words, borders of texts, text number of each run, and the runs (start, end, period) with
    places among all words."""
    words, borders = _numbered(texts)
    numbers = np.asarray(words.dictionary_encode().indices, dtype=np.int64)
    spread = np.arange(len(numbers)) + np.repeat(np.arange(len(texts)), np.diff(borders))
    joined = np.arange(len(numbers) + len(texts)) + len(numbers)  # a number of its own each
    joined[spread] = numbers
    _, joined = np.unique(joined, return_inverse=True)
    start, end, period = find_runs(joined)
    gaps = borders[1:] + np.arange(len(texts))  # places of the borders among ``joined``
    text = np.searchsorted(gaps, start)
    return words, borders, text, (start - text, end - text, period)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=SLICE_BYTES):
            texts = pc.fill_null(part.column(1), "")
            words, borders, text, (start, end, period) = runs_of(texts)
            # Words that some run contains after its first period go: spans are summed up.
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            keep = np.cumsum(change[:-1]) == 0
            kept = np.concatenate([[0], np.cumsum(keep)])[borders].astype(np.int32)
            left = pa.ListArray.from_arrays(pa.array(kept), words.filter(pa.array(keep)))
            runs = pa.StructArray.from_arrays(
                [pa.array(start - borders[text]), pa.array(end - start), pa.array(period)],
                fields=list(_RUN),
            )
            ends = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(borders)),
                    pa.ListArray.from_arrays(pa.array(ends), runs),
                    pc.binary_join(left, pa.scalar(" ", words.type)).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed of each text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of consecutive words
    with smallest period q (words q apart are identical) and at least ``MIN_LENGTH`` words and
    ``MIN_PERIODS`` times q of them, which no neighbouring word extends. Runs may overlap; they
    come by start, then period. ``collapsed`` has the words that no run contains after its first
    q words, joined by one space.

    Each row of ``docs`` gives one row, also rows that are equal or share an id, and rows without
    an id. A null or empty text, or one of blanks, has no words and no runs and collapses to an
    empty text; other columns are ignored; an empty table gives no rows. Nothing is shuffled, and
    a text of any length is one row of one task, which holds some hundred bytes for each word.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(_run, _RUNS_DDL)
