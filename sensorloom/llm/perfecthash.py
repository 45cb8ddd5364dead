"""A minimal perfect hash over 128-bit keys, with a fingerprint and a count for each key.

Keys are placed level by level: on each level a key that shares its slot with no other one keeps
it, the others go on to the next level. The rank of a key's bit among all set bits is its number,
so n keys get the numbers 0 to n-1. Fingerprints of 64 bits and counts lie at these numbers; a key
that is not in the set is told by its fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mix64

# Slots for each key of a level: about three bits a key in all.
SPACE = 2
_LEVEL_STEP = 0x9E3779B97F4A7C15


@dataclass
class PerfectHash:
    levels: np.ndarray  # slots of each level, whole 64-bit words
    bits: np.ndarray  # one word array for all levels
    fingerprints: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.ranks = np.cumsum(ones) - ones

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The count of each key; 0 for keys that are not in the set."""
        found = np.zeros(len(high), dtype=np.int64)
        left = np.arange(len(high))
        base = 0
        for level, size in enumerate(self.levels.tolist()):
            if not len(left):
                break
            slot = base + _slots(high[left], low[left], level, size)
            word, bit = slot >> 6, (slot & 63).astype(np.uint64)
            held = self.bits[word]
            here = (held >> bit) & np.uint64(1) == 1
            number = self.ranks[word[here]] + np.bitwise_count(
                held[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            )
            rows = left[here]
            known = self.fingerprints[number] == _fingerprint(high[rows], low[rows])
            found[rows[known]] = self.counts[number[known]]
            left = left[~here]
            base += size
        return found

    def pack(self) -> dict[str, bytes]:
        """Flat arrays; counts take as few bytes as the largest one needs."""
        counts = self.counts
        for kind in (np.uint8, np.uint16, np.uint32):
            if counts.max(initial=0) <= np.iinfo(kind).max:
                counts = counts.astype(kind)
                break
        return {
            "levels": self.levels.astype("<i8").tobytes(),
            "bits": self.bits.astype("<u8").tobytes(),
            "fingerprints": self.fingerprints.astype("<u8").tobytes(),
            "counts": counts.astype(counts.dtype.newbyteorder("<")).tobytes(),
        }


def unpack(levels: bytes, bits: bytes, fingerprints: bytes, counts: bytes) -> PerfectHash:
    prints = np.frombuffer(fingerprints, dtype="<u8")
    width = len(counts) // len(prints) if len(prints) else 8
    return PerfectHash(
        np.frombuffer(levels, dtype="<i8"),
        np.frombuffer(bits, dtype="<u8"),
        prints,
        np.frombuffer(counts, dtype=f"<u{width}"),
    )


def build(high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> PerfectHash:
    """The hash of distinct keys (high, low), both uint64, with a positive count each."""
    sizes: list[int] = []
    slots: list[np.ndarray] = []
    placed: list[np.ndarray] = []
    left, base = np.arange(len(high)), 0
    while len(left):
        size = -(-SPACE * len(left) // 64) * 64
        slot = _slots(high[left], low[left], len(sizes), size)
        alone = np.bincount(slot, minlength=size)[slot] == 1
        slots.append(base + slot[alone])
        placed.append(left[alone])
        left = left[~alone]
        sizes.append(size)
        base += size
    bits = np.zeros(base // 64, dtype=np.uint64)
    if not sizes:
        empty = np.zeros(0, dtype=np.uint64)
        return PerfectHash(np.zeros(0, dtype=np.int64), bits, empty, empty)
    slot, key = np.concatenate(slots), np.concatenate(placed)
    np.bitwise_or.at(bits, slot >> 6, np.uint64(1) << (slot & 63).astype(np.uint64))
    key = key[np.argsort(slot)]  # the rank of a bit is its place among the set ones
    prints = _fingerprint(high[key], low[key])
    return PerfectHash(np.array(sizes), bits, prints, counts[key].astype(np.uint64))


def _fingerprint(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix64(high) ^ low


def _slots(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((level + 1) * _LEVEL_STEP % (1 << 64))
    mixed = mix64(high ^ mix64(low + step))
    return (mixed % np.uint64(size)).astype(np.int64)
