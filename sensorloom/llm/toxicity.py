"""Toxicity scores of texts whose disguised words are restored first.

The writer of a disguised word is a noisy channel: letters become look-alike signs, are repeated,
or are set apart. A lattice holds what each sign may stand for; a Viterbi search through it under a
character trigram model gives the likeliest word. Words and word beginnings of the restored text
are the features of a logistic model.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct, mix64, slices
from .hashing import prefix, spans, text_bytes

# Bound on the labelled rows of each class that the classifier is fitted on.
FIT_ROWS = 20_000
FEATURE_BITS = 18
SELECTED = 2048
# Bytes of the word beginnings that are features, besides the whole word.
BEGINNINGS = (4, 5, 6, 8)
# Signs of a disguised word at most; longer runs are codes or links and stay as they are.
LONGEST = 40
SLICE_BYTES = 1 << 19

# Signs and the letters they stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
    "£": "l", "¥": "y", "µ": "u", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x",
    "у": "y", "і": "i",
}
SEPARATORS = ".-_*~'`^,:;/\\#%&=\u200b\u00ad"
# Log probabilities of the channel.
LOG_LOOKALIKE = float(np.log(0.2))
LOG_SIGN_AS_BORDER = float(np.log(0.0001))
LOG_SEPARATOR = float(np.log(0.1))
LOG_BORDER = float(np.log(0.9))
LOG_BORDER_APART = float(np.log(0.0001))  # between letters that all stand alone
LOG_REPEAT = float(np.log(0.5))

_SIGNS = re.escape("".join(c for c in LOOKALIKES if not c.isalpha()))
_CYRILLIC = "".join(c for c in LOOKALIKES if c.isalpha())
_APART = re.escape(SEPARATORS)
_LETTER = r"[^\W\d_]"
# Single letters or signs set apart by blanks, or a run that holds signs among letters, a letter
# three times, or Latin and look-alike letters together.
DISGUISED = re.compile(
    rf"(?<!\S)(?:[a-z{_SIGNS}] ){{2,}}[a-z{_SIGNS}](?!\S)"
    rf"|(?<!\S)(?=\S{{3,{LONGEST}}}(?!\S))\S*?"
    rf"(?:{_LETTER}[{_SIGNS}{_APART}]+{_LETTER}|(?<!\S)[{_SIGNS}]+{_LETTER}|{_LETTER}[0-9@$+€£¥]{{1,2}}(?!\S)"
    rf"|({_LETTER})\1\1|[a-z][{_CYRILLIC}]|[{_CYRILLIC}][a-z])\S*"
)
_SET_APART = re.compile(rf"[a-z{_SIGNS}](?:[ {_APART}]+[a-z{_SIGNS}]){{2,}}")
_MAY_BE_DISGUISED = (
    rf"[{_SIGNS}{_APART}][a-z]|[a-z][0-9@$+€£¥]|(^|\s)[a-z{_SIGNS}] [a-z{_SIGNS}] [a-z{_SIGNS}](\s|$)|"
    rf"[a-z][{_CYRILLIC}]|"
    + "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyz")
)

_SYMBOLS = 28  # border, a to z, any other letter
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27
_WORD_BYTE = _SYMBOL > 0


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three letters (or borders) in a row over all texts (column 1) of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                data, borders = text_bytes(pc.utf8_lower(part.column(1).cast(pa.large_string())))
                symbols = np.insert(_SYMBOL[data], borders, 0)
                codes = (symbols[:-2] * _SYMBOLS + symbols[1:-1]) * _SYMBOLS + symbols[2:]
                total += np.bincount(codes, minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    rows = docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(_SYMBOLS**3)
    for row in rows.collect():  # at most one for each cell
        total[row.cell] = row.n
    return total.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter behind two others, smoothed by that behind one."""
    pairs = counts.sum(axis=0)
    behind_one = (pairs + 0.5) / (pairs.sum(axis=1, keepdims=True) + 0.5 * _SYMBOLS)
    return np.log((counts + 4 * behind_one) / (counts.sum(axis=2, keepdims=True) + 4))


def _readings(text: str) -> list[list[tuple[str, float]]]:
    """What each sign may be: letters, a border " ", or nothing, with log probabilities."""
    border = LOG_BORDER_APART if _SET_APART.fullmatch(text) else LOG_BORDER
    lattice = []
    for n, c in enumerate(text):
        if c in LOOKALIKES:
            letters = LOOKALIKES[c]
            options = [(x, LOG_LOOKALIKE - float(np.log(len(letters)))) for x in letters]
            options.append((c, LOG_LOOKALIKE) if c.isalpha() else (" ", LOG_SIGN_AS_BORDER))
        elif c.isalpha():
            options = [(c, 0.0)]
        else:
            options = [("", LOG_SEPARATOR), (" ", border)]
        if n and c == text[n - 1] and c * 3 in text:
            options.append(("", LOG_REPEAT))
        lattice.append(options)
    return lattice


def restore(text: str, model: np.ndarray) -> str:
    """The likeliest reading of a disguised run; spaces in it end words."""
    # Signs that are repeated at either end decorate a word.
    bare = re.sub(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$", "", text).strip(SEPARATORS)
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in _readings(bare):
        best: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, made) in paths.items():
            for letter, cost in options:
                if not letter:
                    state, value = (a, b), (score + cost, made)
                elif letter == " " and b == 0:
                    state, value = (a, b), (score + cost, made)
                else:
                    c = 0 if letter == " " else ord(letter) - 96 if "a" <= letter <= "z" else 27
                    state = (b, c)
                    value = (score + cost + float(model[a, b, c]), made + letter)
                if state not in best or value > best[state]:
                    best[state] = value
        paths = best
    ends = [(s + float(model[a, b, 0]), made) for (a, b), (s, made) in paths.items()]
    return max(ends)[1]


class Restorer:
    """Restores texts; remembers what it has read."""

    def __init__(self, model: np.ndarray):
        self.restore = lru_cache(maxsize=100_000)(lambda run: restore(run, model))

    def text(self, text: str) -> str:
        return DISGUISED.sub(lambda m: self.restore(m[0]), text)

    def texts(self, column: pa.Array) -> pa.Array:
        """All texts lower-cased, with disguised words restored."""
        lower = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
        may = pc.match_substring_regex(lower, _MAY_BE_DISGUISED).to_numpy(zero_copy_only=False)
        if not may.any():
            return lower
        texts = lower.to_pylist()
        for n in np.flatnonzero(may).tolist():
            texts[n] = self.text(texts[n])
        return pa.array(texts, pa.large_string())


_restorers: dict[bytes, Restorer] = {}


def _restorer(model: Broadcast) -> Restorer:
    """One for each worker and model, so that later tasks know what earlier ones have read."""
    key = hashlib.sha256(model.value.tobytes()).digest()
    if key not in _restorers:
        _restorers.clear()
        _restorers[key] = Restorer(model.value)
    return _restorers[key]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature, once for each word and word beginning of a text."""
    data, borders = text_bytes(texts)
    inside = _WORD_BYTE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[borders] = True
    starts = np.flatnonzero(inside & ~(np.concatenate([[False], inside])[:-1] & ~edge[:-1]))
    ends = np.flatnonzero(inside & ~(np.concatenate([inside, [False]])[1:] & ~edge[1:])) + 1
    running = prefix(data)
    text = (np.searchsorted(borders, starts, side="right") - 1).astype(np.int64)
    shift = np.uint64(64 - FEATURE_BITS)
    found = [text << FEATURE_BITS | (mix64(spans(running, starts, ends)) >> shift).view(np.int64)]
    for size in BEGINNINGS:
        long = ends - starts > size
        begin = mix64(spans(running, starts[long], starts[long] + size) + np.uint64(size))
        found.append(text[long] << FEATURE_BITS | (begin >> shift).view(np.int64))
    pairs = distinct(np.concatenate(found))
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)


@dataclass
class Model:
    trigrams: np.ndarray
    weight_at: np.ndarray  # for each feature its place in ``weights``, or -1
    weights: np.ndarray
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """Learns from the rows of ``labels`` (id, 0 or 1) that have a text in ``docs``.

    The character model counts all texts of ``docs``. The classifier is fitted on at most about
    ``FIT_ROWS`` rows of each class, chosen by a hash of the id, and its intercept is set to the
    shares of the classes among all labelled rows.
    """
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    trigrams = language_model(trigram_counts(docs))
    labels = labels.where(f"{id_col} is not null and {label_col} in (0, 1)").select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")
    )
    sizes = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)
    no_weights = np.full(1 << FEATURE_BITS, -1), np.zeros(0)
    prior = float(np.log((positive + 0.5) / (negative + 0.5)))
    if not positive or not negative:
        return Model(trigrams, *no_weights, min(prior, -1.0) if negative or not positive else prior)
    share = F.when(F.col("label") == 1, min(1.0, FIT_ROWS / positive)).otherwise(
        min(1.0, FIT_ROWS / negative)
    )
    chosen = labels.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    chosen = chosen.groupBy("id").agg(F.max("label").alias("label")).orderBy("id").toArrow()
    context = docs.sparkSession.sparkContext
    picked = context.broadcast((chosen["id"].to_numpy(), chosen["label"].to_numpy()))
    shared = context.broadcast(trigrams)

    counted = docs.mapInArrow(_class_counts(picked, shared), "feature int, label int, n long")
    table = np.zeros((2, 1 << FEATURE_BITS))
    rows = np.zeros(2)
    sums = counted.groupBy("feature", "label").agg(F.sum("n").alias("n")).toArrow()
    at, label, n = (sums[c].to_numpy() for c in ("feature", "label", "n"))
    rows[label[at < 0]] = n[at < 0]
    table[label[at >= 0], at[at >= 0]] = n[at >= 0]
    selected = _select(table, rows)
    weight_at = no_weights[0]
    weight_at[selected] = np.arange(len(selected))
    lookup = context.broadcast(weight_at)
    present = docs.mapInArrow(_present(picked, shared, lookup), "label int, held array<int>")
    held = present.toArrow()
    weights, intercept = _logistic(held, len(selected))
    sample = held["label"].to_numpy()
    shift = prior - float(np.log((sample.sum() + 0.5) / (len(sample) - sample.sum() + 0.5)))
    return Model(trigrams, weight_at, weights, intercept + shift)


def _labelled(
    batches: Iterator[pa.RecordBatch], picked: Broadcast, trigrams: Broadcast
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Labels of the chosen rows, and (row, feature) once for each feature of a row."""
    ids, labels = picked.value
    restorer = _restorer(trigrams)
    for batch in batches:
        own = pc.fill_null(batch.column(0), -1).to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        here = np.flatnonzero((ids[place] == own) & batch.column(0).is_valid().to_numpy(False))
        for part in slices(batch.take(pa.array(here)), limit=SLICE_BYTES) if len(here) else ():
            own = part.column(0).to_numpy(zero_copy_only=False)
            row, feature = features(restorer.texts(part.column(1)))
            yield labels[np.searchsorted(ids, own)], row, feature


def _class_counts(picked: Broadcast, trigrams: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, 1 << FEATURE_BITS), dtype=np.int64)
        rows = np.zeros(2, dtype=np.int64)
        for label, row, feature in _labelled(batches, picked, trigrams):
            rows += np.bincount(label, minlength=2)
            for n in (0, 1):
                table[n] += np.bincount(feature[label[row] == n], minlength=table.shape[1])
        label, at = np.nonzero(table)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([at, [-1, -1]]).astype(np.int32)),
                pa.array(np.concatenate([label, [0, 1]]).astype(np.int32)),
                pa.array(np.concatenate([table[label, at], rows])),
            ],
            names=["feature", "label", "n"],
        )

    return run


def _select(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The features whose presence tells most about the label, by the likelihood ratio."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))

    total, seen = max(rows.sum(), 1.0), table.sum(axis=0)
    ratio = np.zeros(table.shape[1])
    for n in (0, 1):
        ratio += part(table[n], rows[n] * seen / total)
        ratio += part(rows[n] - table[n], rows[n] * (total - seen) / total)
    order = np.lexsort((np.arange(len(ratio)), -ratio))[:SELECTED]
    return np.sort(order[ratio[order] > 3.0])


def _present(picked: Broadcast, trigrams: Broadcast, lookup: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, row, feature in _labelled(batches, picked, trigrams):
            at = lookup.value[feature]
            row, at = row[at >= 0], at[at >= 0]
            ends = np.searchsorted(row, np.arange(len(label) + 1))
            held = pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(at.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(label.astype(np.int32)), held], names=["label", "held"]
            )

    return run


def _logistic(held: pa.Table, size: int, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights of a penalised logistic model over sets of features, by accelerated descent."""
    label = held["label"].to_numpy().astype(float)
    lists = held["held"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    ends = np.asarray(lists.offsets)
    column = lists.values.to_numpy()[ends[0] : ends[-1]]
    row = np.repeat(np.arange(len(label)), np.diff(ends))
    # A fixed order of rows makes sums, and so weights, the same in every run.
    key = np.lexsort((np.bincount(row, mix64(column.astype(np.uint64)) >> np.uint64(40), len(label)), label))
    place = np.empty(len(label), dtype=np.int64)
    place[key] = np.arange(len(label))
    order = np.lexsort((column, place[row]))
    row, column, label = place[row][order], column[order], label[key]
    weights, bias = np.zeros(size), 0.0
    ahead, ahead_bias, momentum = weights, bias, 1.0
    step = 4.0 / (1 + max(1, int(np.diff(ends).max(initial=1))) + penalty / max(len(label), 1))
    step /= max(len(label), 1)
    for _ in range(600):
        value = ahead_bias + np.bincount(row, ahead[column], len(label))
        error = 1 / (1 + np.exp(-value)) - label
        new = ahead - step * (np.bincount(column, error[row], size) + penalty * ahead)
        new_bias = ahead_bias - step * error.sum()
        more = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / more * (new - weights)
        ahead_bias = new_bias + (momentum - 1) / more * (new_bias - bias)
        weights, bias, momentum = new, new_bias, more
    return weights, float(bias)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns named in ``keep``, score (0 to 1) and predicted of each row of ``docs``
    (doc_id, text).

    Each row is judged by its text alone. Null and empty texts, and texts without words, get the
    score of the intercept; a null id stays null; equal rows get equal scores; columns not named
    are ignored; an empty table gives no rows. If only one class, or none, is labelled, all texts
    get one score.
    """
    context = docs.sparkSession.sparkContext
    trigrams, shared = context.broadcast(model.trigrams), context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, restorer = shared.value, _restorer(trigrams)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                row, feature = features(restorer.texts(part.column(1)))
                at = own.weight_at[feature]
                row, at = row[at >= 0], at[at >= 0]
                value = np.bincount(row, own.weights[at], minlength=part.num_rows)
                result = 1 / (1 + np.exp(-np.clip(own.intercept + value, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[2:], pa.array(result),
                     pa.array((result >= 0.5).astype(np.int32))],
                    names=["doc_id", *keep, "score", "predicted"],
                )

    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long", *(f"`{c}` {kinds[c]}" for c in keep)])
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep)
    return chosen.mapInArrow(run, schema + ", score double, predicted int")
