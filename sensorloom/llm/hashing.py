"""Vectorised hashes of spans of bytes, for whole Arrow slices at once."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import mix64

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``length`` of each."""
    have = _powers.get(0)
    if have is None or len(have[0]) < length:
        size = max(length, 1 << 18)
        up = np.full(size, BASE)
        down = np.full(size, INVERSE)
        up[0] = down[0] = 1
        _powers[0] = have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, end to end, and the border of each row (nulls are empty)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    borders = np.frombuffer(column.buffers()[1], dtype=np.int64)
    borders = borders[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, dtype=np.uint8), borders - borders[0]
    data = np.frombuffer(data, dtype=np.uint8)[borders[0] : borders[-1]]
    return data, borders - borders[0]


def prefix(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Running polynomial hash; ``spans`` takes the hash of any span from it."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    rest = out[1:]  # all in this one array: texts are long, and tasks are many
    np.take(values, data, out=rest, mode="clip")
    rest *= powers(len(data))[0][: len(data)]
    np.cumsum(rest, out=rest)
    return out


def rolling(running: np.ndarray, width: int) -> np.ndarray:
    """``spans`` of every ``width`` bytes."""
    out = running[width:] - running[:-width]
    out *= powers(len(out))[1][: len(out)]
    return out


def spans(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of the bytes from each start to its end, the same wherever they stand."""
    return (running[ends] - running[starts]) * powers(len(running))[1][starts]


def word_spans(
    data: np.ndarray, borders: np.ndarray, blank: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the index of its first word (and the total).
    ``blank`` says which bytes part words."""
    space = blank[data]
    before = np.ones(len(data), dtype=bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:]
    inner = borders[(borders > 0) & (borders < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, borders)


@cache
def _lower_values() -> np.ndarray:
    return BYTE_VALUES[LOWER]


def word_hashes(
    data: np.ndarray, borders: np.ndarray, blank: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lower-cased, then what ``word_spans`` returns."""
    starts, ends, first = word_spans(data, borders, blank)
    hashes = mix64(spans(prefix(data, _lower_values()), starts, ends))
    return hashes, starts, ends, first
