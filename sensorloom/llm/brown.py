"""Class-based bigram language model with classes from exchange clustering.

The most frequent words are clustered by exchange so that class bigrams tell most about each other.
Every further known word goes to the class that its neighbours in all of the corpus make likeliest:
their classes are counted by a shuffle, and words are assigned in Spark tasks. A text's probability
is the product of class transitions and of word emissions. New words, and words beyond the known
ones, are in classes by their shape; words that were seen once tell where new words stand.

Words are known by 64-bit hashes of their lower-cased bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, whole_groups
from .hashing import text_bytes, word_hashes

# Bounds on the model that goes to every task: words that start the clustering, words whose classes
# and counts are sent along (counts of rarer words are looked up by a join), and classes.
CLUSTERED = 1024
KNOWN = 1 << 18
CLASSES = 64
EXCHANGE_ROUNDS = 20
SLICE_BYTES = 1 << 20
# Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 1 << 20
# Counts are grouped by the logarithm to find how many words are frequent, without a sort.
_BANDS_PER_DOUBLING = 8
# Shapes of words: how they end (letter, full stop, comma, other), and whether all are ASCII.
SHAPES = 8

_ENDING = np.full(256, 3)
_ENDING[97:123] = _ENDING[65:91] = 0
_ENDING[128:] = 0
_ENDING[ord(".")] = 1
_ENDING[ord(",")] = 2

SCORED_DDL = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
    "model double, rare array<long>"
)


@dataclass
class Model:
    train_tokens: int
    texts: int  # training texts, that is how often the end token was seen
    vocabulary: int
    known: np.ndarray  # hashes, ascending
    known_counts: np.ndarray
    known_classes: np.ndarray  # class of each known word
    emission: np.ndarray  # log10 probability in its class of each known word
    transition: np.ndarray  # log10, over the classes, the shapes and the border of texts
    new_word: np.ndarray  # log10 probability of each word never seen, by shape

    @property
    def rest(self) -> int:
        """The class of the first shape."""
        return len(self.transition) - 1 - SHAPES

    @property
    def border(self) -> int:
        return len(self.transition) - 1


def read_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of each word, and the index of each text's first word (and the total)."""
    data, borders = text_bytes(texts)
    hashes, starts, ends, first = word_hashes(data, borders)
    beyond = np.concatenate([[0], np.cumsum(data >= 128)])
    shapes = _ENDING[data[ends - 1]] * 2 + (beyond[ends] > beyond[starts])
    return hashes, shapes, first


def count_words(docs: DataFrame) -> DataFrame:
    """word, shape and n over the texts (column 1) of ``docs``; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(0, dtype=np.uint64)
        shapes = counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                hashes, forms, _ = read_words(part.column(1))
                words = np.concatenate([words, hashes])
                words, at, place = np.unique(words, return_index=True, return_inverse=True)
                shapes = np.concatenate([shapes, forms])[at]
                counts = np.concatenate([counts, np.ones(len(hashes), dtype=np.int64)])
                counts = np.bincount(place, counts, len(words)).astype(np.int64)
                if len(words) > HELD_WORDS:
                    yield _batch(word=words.view(np.int64), shape=shapes, n=counts)
                    words, shapes, counts = words[:0], shapes[:0], counts[:0]
        yield _batch(word=words.view(np.int64), shape=shapes, n=counts)

    partial = docs.mapInArrow(run, "word long, shape long, n long")
    return partial.groupBy("word").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=[*columns])


def frequent(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The words of the highest count bands that hold at most ``most`` words, and all others."""
    band = F.floor(F.log2("n") * _BANDS_PER_DOUBLING)
    bands = counts.groupBy(band.alias("band")).agg(F.count("*").alias("words")).collect()
    total, lowest = 0, None
    for row in sorted(bands, key=lambda r: -r.band):
        total += row.words
        if total > most:
            break
        lowest = row.band
    if lowest is None:
        return counts.limit(0), counts
    return counts.where(band >= lowest), counts.where(band < lowest)


def class_bigrams(docs: DataFrame, known: np.ndarray, number: np.ndarray, size: int) -> np.ndarray:
    """Counts of (symbol, next symbol) over ``docs``: a known word is its number, any other word
    ``size`` and its shape, and the border of texts comes last. The table is bounded by ``size``."""
    border = size + SHAPES
    width = border + 1
    shared = docs.sparkSession.sparkContext.broadcast((known, number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                hashes, shapes, first = read_words(part.column(1))
                own = _lookup(hashes, *shared.value, size + shapes)[0]
                symbols = _with_borders(own, first, border)
                before = np.concatenate([[border], symbols[:-1]])
                table += np.bincount(before * width + symbols, minlength=len(table))
        cells = np.flatnonzero(table)
        yield _batch(cell=cells, n=table[cells])

    sums = docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    table = np.zeros(width * width, dtype=np.int64)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(width, width)


def _lookup(
    hashes: np.ndarray, known: np.ndarray, values: np.ndarray, missing: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The value of each hash, or what ``missing`` has for it; and its place, or -1."""
    if not len(known):
        return missing, np.full(len(hashes), -1)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    here = known[place] == hashes
    return np.where(here, values[place], missing), np.where(here, place, -1)


def _with_borders(values: np.ndarray, first: np.ndarray, border: float) -> np.ndarray:
    """The values of all words with one border value behind each text."""
    texts = len(first) - 1
    out = np.full(len(values) + texts, border, dtype=values.dtype)
    out[np.arange(len(values)) + np.repeat(np.arange(texts), np.diff(first))] = values
    return out


def exchange(bigrams: np.ndarray, size: int, classes: int = CLASSES) -> np.ndarray:
    """Class of each of ``size`` words: moves words to the class that raises the likelihood of the
    class bigrams most, until a round moves few. Symbols behind the words stay classes of their
    own. Ties keep a word or go to the first class."""
    classes = min(classes, size)
    total = classes + len(bigrams) - size
    owner = np.concatenate([np.arange(size) % max(classes, 1), np.arange(classes, total)])
    member = np.eye(total)[owner]
    table = member.T @ bigrams @ member
    after = bigrams @ member  # of each word, by class of the next
    before = (member.T @ bigrams).T  # by class of the one before
    self_count = np.diagonal(bigrams).astype(float)

    def entropy(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    for _ in range(EXCHANGE_ROUNDS):
        moved = 0
        for word in range(size):
            old = owner[word]
            out, into, own = after[word], before[word], self_count[word]
            table[old] -= out
            table[:, old] -= into
            table[old, old] += own
            # Without the word itself, which moves along with it.
            out, into = out.copy(), into.copy()
            out[old] -= own
            into[old] -= own
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            n_out, n_in = out.sum() + own, into.sum() + own
            gain = (entropy(table + out) - entropy(table)).sum(axis=1)
            gain += (entropy(table.T + into) - entropy(table.T)).sum(axis=1)
            diagonal = np.diagonal(table)
            gain += entropy(diagonal + out + into + own) + entropy(diagonal)
            gain -= entropy(diagonal + out) + entropy(diagonal + into)
            gain -= entropy(rows + n_out) - entropy(rows)
            gain -= entropy(columns + n_in) - entropy(columns)
            new = int(np.argmax(gain[:classes]))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += out
            table[:, new] += into
            table[new, new] += own
            if new != old:
                moved += 1
                owner[word] = new
                for counts, column in ((after, bigrams[:, word]), (before, bigrams[word])):
                    counts[:, old] -= column
                    counts[:, new] += column
        if moved * 200 < size:
            break
    return owner[:size]


def transitions(table: np.ndarray) -> np.ndarray:
    """Probabilities of the next class. Witten-Bell: as much goes to the unigram of classes as a
    class had different followers."""
    totals = table.sum(axis=0)
    overall = (totals + 1) / (totals.sum() + len(totals))
    seen, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
    return np.where(
        seen + kinds > 0, (table + kinds * overall) / np.maximum(seen + kinds, 1), overall
    )


def class_gains(table: np.ndarray, classes: int) -> np.ndarray:
    """What each occurrence adds to the log likelihood of a word's being in each of the classes:
    rows are the symbols that follow the word, then those before it."""
    next_class = np.log(transitions(table))
    totals = np.maximum(table.sum(axis=0)[:classes], 1)
    return np.concatenate([next_class[:classes].T, next_class[:, :classes] - np.log(totals)])


def assign_classes(
    docs: DataFrame, known: np.ndarray, number: np.ndarray, free: np.ndarray, gains: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``known`` of the ``free`` words, and the likeliest class of each, from the symbols
    on both sides of all its occurrences in ``docs``; ``number`` is the symbol of each known word.
    Ties go to the first class."""
    width, classes = gains.shape[0] // 2, gains.shape[1]
    border, shaped = width - 1, width - 1 - SHAPES
    shared = docs.sparkSession.sparkContext.broadcast((known, number, free))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        words, numbers, wanted = shared.value
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                hashes, shapes, first = read_words(part.column(1))
                own, place = _lookup(hashes, words, numbers, shaped + shapes)
                symbols = _with_borders(own, first, border)
                places = _with_borders(place, first, -1)
                at = np.flatnonzero(places >= 0)
                at = at[wanted[places[at]]]
                after = symbols[np.minimum(at + 1, len(symbols) - 1)]
                before = np.where(at > 0, symbols[at - 1], border)
                base = places[at] * (2 * width)
                cells = np.concatenate([cells, base + after, base + width + before])
                counts = np.concatenate([counts, np.ones(2 * len(at), dtype=np.int64)])
                cells, back = np.unique(cells, return_inverse=True)
                counts = np.bincount(back, counts, len(cells)).astype(np.int64)
                if len(cells) > HELD_WORDS:
                    yield _batch(place=cells // (2 * width), cell=cells % (2 * width), n=counts)
                    cells, counts = cells[:0], counts[:0]
        yield _batch(place=cells // (2 * width), cell=cells % (2 * width), n=counts)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches):
            place, cell, n = (batch.column(c).to_numpy() for c in range(3))
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            sums = [
                np.add.reduceat(gains[cell, k] * n, starts) for k in range(classes)
            ]
            best = np.argmax(np.array(sums), axis=0)
            yield _batch(place=place[starts], owner=best.astype(np.int64))

    # A word's rows meet in one task: two symbols for each class and read slice at most.
    rows = docs.mapInArrow(read, "place long, cell long, n long").repartition("place")
    rows = rows.groupBy("place", "cell").agg(F.sum("n").alias("n"))
    chosen = rows.sortWithinPartitions("place", "cell").mapInArrow(choose, "place long, owner long")
    found = chosen.toArrow()  # at most one row for each known word
    return found["place"].to_numpy(), found["owner"].to_numpy()


def fit(docs: DataFrame, counts: DataFrame | None = None) -> Model:
    """Learns from all texts (column 1) of ``docs``. Counts cover every word; the model itself is
    bounded by ``KNOWN`` and ``CLASSES``, and the exchange in the driver by ``CLUSTERED``."""
    counts = stored(count_words(docs), "word_counts") if counts is None else counts
    texts = docs.count()
    by_shape = {r["shape"]: r for r in counts.groupBy("shape").agg(
        F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once")
    ).collect()}
    tokens = sum(r.n for r in by_shape.values()) + texts
    vocabulary = sum(r.words for r in by_shape.values()) + (texts > 0)
    found = frequent(counts, KNOWN)[0].toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    known, known_counts = found["word"].to_numpy().view(np.uint64), found["n"].to_numpy()
    shapes = found["shape"].to_numpy()
    size = min(len(known), CLUSTERED)
    order = np.argsort(known)
    number = np.where(np.arange(len(known)) < size, np.arange(len(known)), size + shapes)
    bigrams = class_bigrams(docs, known[order], number[order], size)
    owner = exchange(bigrams, size)
    classes = min(size, CLASSES)
    member = np.eye(classes + SHAPES + 1)[
        np.concatenate([owner, np.arange(classes, classes + SHAPES + 1)]).astype(int)
    ]
    seeds = member.T @ bigrams @ member
    known_classes = np.concatenate([owner, classes + shapes[size:]]).astype(np.int64)[order]
    table = seeds
    if len(known) > size:
        free = (np.arange(len(known)) >= size)[order]
        place, chosen = assign_classes(
            docs, known[order], known_classes, free, class_gains(seeds, classes)
        )
        known_classes[place] = chosen
        table = class_bigrams(docs, known[order], known_classes, classes).astype(float)
    # Where words of a shape that are no seeds stand, new ones are expected: as often as words of
    # that shape were seen once.
    ones = np.array([by_shape[s].once if s in by_shape else 0 for s in range(SHAPES)])
    shaped = slice(classes, classes + SHAPES)
    share = ones / np.maximum(seeds[shaped].sum(axis=1), 1)
    new = np.zeros_like(seeds, dtype=float)
    new[shaped] = seeds[shaped] * share[:, None]
    new[:classes, shaped] = seeds[:classes, shaped] * share
    new[-1, shaped] = seeds[-1, shaped] * share
    seen = table.sum(axis=0)
    table = table + (new if len(known) > size else 0)
    totals = table.sum(axis=0)
    # A shape class holds its words that are not known, each once more than seen, and a new one.
    known_shapes = np.bincount(shapes, minlength=SHAPES)
    shape_words = np.array([by_shape[s].words if s in by_shape else 0 for s in range(SHAPES)])
    new_word = -np.log10(totals[classes:-1] + shape_words - known_shapes + 1)
    emission = np.log10(known_counts[order] / np.maximum(seen[known_classes], 1))
    return Model(
        tokens, texts, vocabulary, known[order], known_counts[order], known_classes, emission,
        np.log10(transitions(table)), new_word,
    )


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of
    ``docs`` (doc_id, text, held_out).

    Words beyond the model's known ones are kept with the row and joined with ``counts`` (all word
    counts of the training texts); everything else is summed where the text is read. A null or
    empty text is the end token alone; a null id stays null; equal rows are scored one by one;
    without training texts every token is new.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                columns = _score_part(part, shared.value)
                rows = pa.array(np.arange(row, row + part.num_rows))
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [rows, part.column(0), part.column(2), *columns],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"],
                )

    rows = stored(docs.select("doc_id", "text", "held_out").mapInArrow(run, SCORED_DDL), "scored")
    rare_counts = frequent(counts, KNOWN)[1].select("word", F.col("n").alias("seen"))
    rare = rows.select("row", F.explode("rare").alias("word")).groupBy("row", "word").count()
    found = rare.join(rare_counts, "word").groupBy("row").agg(
        F.sum(F.col("count") * F.log10(F.col("seen") + 1)).alias("gain"),
        F.sum("count").alias("found"),
    )
    gain = F.coalesce("gain", F.lit(0.0))
    return rows.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("model") + gain).alias("score"),
    )


def _score_part(part: pa.RecordBatch, model: Model) -> list[pa.Array]:
    """Sums for each text as if none of its rare words had been seen, and those words."""
    hashes, shapes, first = read_words(part.column(1))
    classes, place = _lookup(hashes, model.known, model.known_classes, model.rest + shapes)
    seen = place >= 0
    starts = first[:-1] + np.arange(len(first) - 1)
    total = np.log10(model.train_tokens + model.vocabulary + 1)
    base, emitted = np.zeros(len(hashes)), model.new_word[shapes]
    base[seen] = np.log10(model.known_counts[place[seen]] + 1)
    emitted[seen] = model.emission[place[seen]]
    base = _with_borders(base, first, np.log10(model.texts + 1)) - total
    symbols = _with_borders(classes, first, model.border)
    before = np.concatenate([[model.border], symbols[:-1]])
    scores = model.transition[before, symbols] + _with_borders(emitted, first, 0.0)
    lengths = np.diff(first)
    known = np.add.reduceat(_with_borders(seen.astype(np.int64), first, 0), starts)
    rare_words = hashes[~seen].view(np.int64)
    rare_ends = np.concatenate([[0], np.cumsum(~seen)])[first]
    return [
        pa.array(lengths + 1),
        pa.array(known + (model.texts > 0)),
        pa.array(np.add.reduceat(base, starts)),
        pa.array(np.add.reduceat(scores, starts)),
        pa.ListArray.from_arrays(pa.array(rare_ends.astype(np.int32)), pa.array(rare_words)),
    ]
