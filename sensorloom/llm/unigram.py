"""Token counts under a unigram vocabulary, by a Viterbi search that carries counts only.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic
programming keeps the best score and its number of pieces for each prefix. Ties go to the longest
last piece, as in the unigram model of the ``tokenizers`` library, and characters that no piece
spells count as their UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
# An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
# Chunks whose counts a worker remembers, and how long they may be.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 48

_CHUNKS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, in the order of their ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(n), model.get_score(n)) for n in range(model.get_piece_size())]


class Counter:
    """Counts pieces of texts; made once per worker and vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        singles = set()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
                if len(piece) == 1:
                    singles.add(piece)
        self.singles = singles
        self.unknown = min((float(s) for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        if len(self.automaton):
            self.automaton.make_automaton()
        # Text may be cut before a run of spaces if no piece goes across such a place, and if
        # scores are whole numbers, so that sums of parts are exact.
        self.cut = all(
            not re.search(f"[^{SPACE}]{SPACE}", piece) and float(score).is_integer()
            for piece, score in vocabulary
        )
        self.counts: dict[str, int] = {}

    def chunk(self, text: str) -> int:
        """Pieces of the best path through ``text``, which is searched as a whole."""
        length = len(text)
        best = [0.0] + [float("-inf")] * length
        pieces = [0] * (length + 1)
        singles, unknown = self.singles, self.unknown
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        end, (size, score) = next(matches, (length, (0, 0.0)))
        for at, char in enumerate(text):
            top, count = float("-inf"), 0
            while end == at:  # the longest piece comes first, and keeps a tie
                candidate = best[at + 1 - size] + score
                if candidate > top:
                    top, count = candidate, pieces[at + 1 - size] + 1
                end, (size, score) = next(matches, (length, (0, 0.0)))
            if char not in singles and best[at] + unknown > top:
                top, count = best[at] + unknown, pieces[at] + len(char.encode())
            best[at + 1], pieces[at + 1] = top, count
        return pieces[length]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if not self.cut:
            return self.chunk(text)
        total, known = 0, self.counts
        for chunk in _CHUNKS.findall(text):
            n = known.get(chunk)
            if n is None:
                n = self.chunk(chunk)
                if len(chunk) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[chunk] = n
            total += n
        return total


_counters: dict[str, Counter] = {}


def counter(path: str, vocabulary: list[tuple[str, float]]) -> Counter:
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(vocabulary)
    return _counters[path]


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """doc_id and n_tokens of each row: the number of pieces of its text, nothing else is built.

    A space is put before the text and spaces are written as the vocabulary writes them. Null and
    empty texts have 0 tokens; a null id stays null; equal rows are counted one by one; other
    columns are ignored; an empty table gives no rows. Nothing is shuffled; the vocabulary, whose
    size is that of its file, goes to every task.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, shared.value).count
        for batch in batches:
            for part in slices(batch):
                counts = np.fromiter(
                    (count(t or "") for t in part.column(1).to_pylist()), np.int64, part.num_rows
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts)], names=["doc_id", "n_tokens"]
                )

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, "doc_id long, n_tokens long")
