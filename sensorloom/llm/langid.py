"""Language identification by the nearest of several clustered centroids per language.

A text is a vector of hashed byte bigrams and trigrams, weighted by TF-IDF and normalised. Each
language has a few centroids, found by spherical k-means; a text takes the language of the centroid
with the largest cosine, and is rejected where even that is far away.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .hashing import LOWER, text_bytes

DIMENSIONS = 4096
CLUSTERS = 4
# Bound on the labelled rows per language that k-means starts from; all rows refine its result.
SEED_ROWS = 1000
# Bound on the learned languages, and so on the model that goes to every task.
MAX_LANGUAGES = 512
UNDETERMINED = "und"
# A text is rejected below this share of the median similarity of training texts of its length.
# Similarities of short texts spread more.
REJECT_SHARE = 0.3
SHORT_SHARE, SHORT_CLASSES = 0.25, 8
# Rows of one length that tell a median; with fewer, the lengths around it are added.
MEDIAN_ROWS = 20
# N-grams of a text that is as near to its centroid as 45 degrees, about.
_HALF_WAY = 400
# Classes of length are powers of two of the number of n-grams; the last has no upper end.
LENGTH_CLASSES = 16
_SIMILARITY_BINS = 200
_CELLS = LENGTH_CLASSES * _SIMILARITY_BINS

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_FOLDED = LOWER.copy()
_FOLDED[:128][~_LETTERS[:128]] = 32
_FOLDED = _FOLDED.astype(np.uint32)
_MULTIPLIER = np.uint32(2654435761)
_SHIFT = np.uint32(32 - DIMENSIONS.bit_length() + 1)
_SPACES = (0x2020, 0x202020)
_SALTS = (np.uint32(0), np.uint32(0x5A000000))


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # least similarity that is not rejected, of each centroid and length class


def _codes(folded: np.ndarray) -> list[np.ndarray]:
    pairs = folded[:-1] | (folded[1:] << np.uint32(8))
    triples = pairs[:-1] | (folded[2:] << np.uint32(16))
    return [((v + salt) * _MULTIPLIER) >> _SHIFT for v, salt in zip((pairs, triples), _SALTS)]


_BLANK_CODES = [
    int(((np.array([v], dtype=np.uint32) + salt) * _MULTIPLIER >> _SHIFT)[0])
    for v, salt in zip(_SPACES, _SALTS)
]


def counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of each text, and whether it has a letter."""
    data, borders = text_bytes(texts)
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    lettered = np.zeros(len(texts), dtype=bool)
    if not len(data):
        return out, lettered
    # Padded to equal lengths; n-grams never leave their own text.
    codes = _codes(np.concatenate([_FOLDED[data], np.full(2, 32, dtype=np.uint32)]))
    ascii_letter = np.concatenate([[0], np.cumsum(_LETTERS[data])])
    beyond = np.concatenate([[0], np.cumsum(data >= 128)])
    for row, (start, stop) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
        lettered[row] = ascii_letter[stop] > ascii_letter[start] or (
            beyond[stop] > beyond[start] and any(c.isalpha() for c in texts[row].as_py())
        )
        if lettered[row]:
            for size, code in enumerate(codes, 1):
                grams = code[start : max(start, stop - size)]
                out[row] += np.bincount(grams, minlength=DIMENSIONS)
    out[:, _BLANK_CODES] = 0
    return out, lettered


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(raw) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def length_classes(raw: np.ndarray) -> np.ndarray:
    grams = np.maximum(raw.sum(axis=1, dtype=np.float64), 1)
    return np.minimum(np.log2(grams), LENGTH_CLASSES - 1).astype(np.int64)


def _seeds(points: np.ndarray) -> np.ndarray:
    """Spherical k-means from a seeded start; fewer centroids where points coincide."""
    random = np.random.default_rng(0)
    chosen = [points[0]]
    for _ in range(1, min(CLUSTERS, len(points))):
        far = np.clip(1 - np.max(points @ np.array(chosen).T, axis=1), 0, None) ** 2
        if far.sum() < 1e-9:
            break
        chosen.append(points[random.choice(len(points), p=far / far.sum())])
    centroids = np.array(chosen)
    for _ in range(10):
        nearest = np.argmax(points @ centroids.T, axis=1)
        sums = np.array([points[nearest == c].sum(axis=0) for c in range(len(centroids))])
        sums = sums[np.any(sums != 0, axis=1)]
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    """Learns from all rows of ``docs`` that have a language and a letter.

    Document frequencies, centroids and rejection floors come from every row; only the start of
    k-means comes from about ``SEED_ROWS`` rows of each language, chosen by a hash of the id. What
    reaches the driver is the model alone: at most ``MAX_LANGUAGES`` times ``CLUSTERS`` vectors.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    rows = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not rows:
        empty = np.zeros((0, DIMENSIONS), dtype=np.float32)
        return Model([], empty, np.ones(DIMENSIONS, dtype=np.float32), np.zeros((0, LENGTH_CLASSES)))
    frequencies = np.zeros(DIMENSIONS + 1)
    found = labelled.select("id", "text").mapInArrow(_frequencies, "dim int, n long")
    for row in found.groupBy("dim").agg(F.sum("n").alias("n")).collect():
        frequencies[row.dim] = row.n
    idf = np.log((1 + frequencies[-1]) / (1 + frequencies[:-1])) + 1
    idf = idf.astype(np.float32)

    share = F.lit(0)
    for row in rows:
        part = min(1 << 20, int((SEED_ROWS << 20) / row["count"]) + 1)
        share = F.when(F.col("lang") == row["lang"], part).otherwise(share)
    sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share)
    seeds = _centroid_rows(sample, idf)
    if not seeds:
        return Model([], np.zeros((0, DIMENSIONS), dtype=np.float32), idf, np.zeros((0, LENGTH_CLASSES)))
    return _refined(labelled, idf, [s[0] for s in seeds], np.array([s[1] for s in seeds]))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for batch in batches:
        for part in slices(batch):
            raw, lettered = counts(part.column(1))
            found[:-1] += np.count_nonzero(raw, axis=0)
            found[-1] += np.count_nonzero(lettered)
    dims = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(dims.astype(np.int32)), pa.array(found[dims])], names=["dim", "n"]
    )


def _centroid_rows(sample: DataFrame, idf: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """k-means per language over the seed rows, which are few by construction."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw, lettered = counts(part.column(1))
                rows = [v.tobytes() for v in vectors(raw, idf)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(rows, pa.binary()), part.column(2)],
                    names=["id", "vector", "lang"],
                ).filter(pa.array(lettered))

    def cluster(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        points = np.frombuffer(b"".join(group["vector"].to_pylist()), dtype=np.float32)
        found = _seeds(points.reshape(-1, DIMENSIONS)).astype(np.float32)
        return pa.table(
            {
                "lang": pa.array([group["lang"][0].as_py()] * len(found), pa.string()),
                "vector": pa.array([v.tobytes() for v in found], pa.binary()),
            }
        )

    embedded = sample.mapInArrow(embed, "id string, vector binary, lang string")
    found = embedded.groupBy("lang").applyInArrow(cluster, "lang string, vector binary").collect()
    found = sorted((r.lang, bytes(r.vector)) for r in found)
    return [(lang, np.frombuffer(v, dtype=np.float32)) for lang, v in found]


def _refined(labelled: DataFrame, idf: np.ndarray, owners: list[str], seeds: np.ndarray) -> Model:
    """One pass over all rows: each joins the nearest seed of its language. Tasks add up vectors
    and similarities, so the shuffle holds the sums of tasks, not rows."""
    names = np.array(owners, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(owners), DIMENSIONS + _CELLS))
        for batch in batches:
            for part in slices(batch):
                raw, lettered = counts(part.column(1))
                points = vectors(raw, idf)
                like = points @ seeds.T
                own = np.array(part.column(2).to_pylist(), dtype=object)
                like[own[:, None] != names[None, :]] = -1
                best, top = np.argmax(like, axis=1), np.max(like, axis=1)
                top[~lettered] = -1
                length = length_classes(raw)
                for c in range(len(owners)):
                    mine = (best == c) & (top >= 0)
                    sums[c, :DIMENSIONS] += points[mine].sum(axis=0)
                    bins = np.minimum(top[mine] * _SIMILARITY_BINS, _SIMILARITY_BINS - 1)
                    sums[c, DIMENSIONS:] += np.bincount(
                        length[mine] * _SIMILARITY_BINS + bins.astype(np.int64), minlength=_CELLS
                    )
        at, dim = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at.astype(np.int32)),
                pa.array(dim.astype(np.int32)),
                pa.array(np.rint(sums[at, dim] * (1 << 20)).astype(np.int64)),
            ],
            names=["centroid", "dim", "total"],
        )

    # Sums of whole numbers do not depend on the order of tasks.
    totals = labelled.mapInArrow(run, "centroid int, dim int, total long")
    totals = totals.groupBy("centroid", "dim").agg(F.sum("total").alias("total"))
    sums = np.zeros((len(owners), DIMENSIONS + _CELLS))
    cells = totals.toArrow()
    place = cells["centroid"].to_numpy(), cells["dim"].to_numpy()
    sums[place] = cells["total"].to_numpy() / (1 << 20)
    norms = np.linalg.norm(sums[:, :DIMENSIONS], axis=1, keepdims=True)
    centroids = np.where(norms > 0, sums[:, :DIMENSIONS] / np.maximum(norms, 1e-12), seeds)
    seen = sums[:, DIMENSIONS:].reshape(len(owners), LENGTH_CLASSES, _SIMILARITY_BINS)
    floor = np.array([
        _floors(own, seen[names == name].sum(axis=0)) for own, name in zip(seen, names)
    ])
    return Model(owners, centroids.astype(np.float32), idf, floor)


def _floors(own: np.ndarray, language: np.ndarray) -> np.ndarray:
    """The floor of each length class of a centroid, from the similarities of its texts of that
    length; where they are few from those of the language, then from lengths around it.

    Half of the rows would have to be junk to move a median, and texts of other lengths do not.
    A median over several lengths is brought to the own one as similarities grow with length.
    """
    grams = 1.5 * 2.0 ** np.arange(LENGTH_CLASSES)
    usual = np.sqrt(grams / (grams + _HALF_WAY))
    out = np.zeros(LENGTH_CLASSES)
    for length in range(LENGTH_CLASSES):
        pool = np.zeros_like(own)
        pool[length] = own[length]
        for more in range(LENGTH_CLASSES):
            if pool.sum() >= MEDIAN_ROWS:
                break
            near = slice(max(0, length - more), length + more + 1)
            pool[near] = language[near]
        seen = np.cumsum(pool.sum(axis=0))
        median = int(np.searchsorted(seen, seen[-1] / 2)) / _SIMILARITY_BINS
        rows = pool.sum(axis=1)
        scale = usual[length] / np.average(usual, weights=rows) if rows.sum() else 0
        share = SHORT_SHARE if length < SHORT_CLASSES else REJECT_SHARE
        out[length] = share * median * scale
    return out


def predict(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    results: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
) -> DataFrame:
    """The rows of ``docs`` with lang_pred, score (the cosine, 0 to 1) and rejected, or under the
    names in ``results``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected. Other texts always
    get a learned language; rejected tells that the nearest centroid is too far away. If nothing
    was learned they are ``und`` too, but not rejected. Each row is judged by its text alone: equal texts get equal
    results, of equal cosines the first language in the alphabet wins, columns named like the
    results are replaced, and other columns pass unchanged.
    """
    docs = docs.drop(*results)
    at = docs.columns.index(text_col)
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, results, kinds)])
    columns = [*docs.columns, *results]
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                raw, lettered = counts(part.column(at))
                best = np.full(len(raw), len(model.languages))
                score = np.zeros(len(raw))
                rejected = ~lettered
                if lettered.any() and model.languages:
                    like = vectors(raw[lettered], model.idf) @ model.centroids.T
                    best[lettered] = nearest = np.argmax(like, axis=1)
                    score[lettered] = np.clip(np.max(like, axis=1), 0, 1)
                    rejected[lettered] = (
                        score[lettered] < model.floor[nearest, length_classes(raw[lettered])]
                    )
                added = [pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *added], names=columns
                )

    return docs.mapInArrow(run, schema)
