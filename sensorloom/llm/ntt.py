"""Exact integer convolution of many short rows at once: a number-theoretic transform modulo a
prime, in numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

# 15 * 2**27 + 1: products of two residues fit 64 bits, and transforms reach 2**27 places.
PRIME = 2013265921
ROOT = 31  # generates the residues
_P = np.uint64(PRIME)


@cache
def _twiddles(size: int, inverse: bool) -> list[np.ndarray]:
    """For each halving, the powers of the root of unity of that length."""
    out = []
    while size > 1:
        root = pow(ROOT, (PRIME - 1) // size, PRIME)
        if inverse:
            root = pow(root, -1, PRIME)
        powers = np.ones(1, dtype=np.uint64)
        step = root
        while len(powers) < size // 2:  # doubling: powers 0..k-1, then times root**k
            powers = np.concatenate([powers, powers * np.uint64(step) % _P])
            step = step * step % PRIME
        out.append(powers)
        size //= 2
    return out


def forward(rows: np.ndarray) -> np.ndarray:
    """The transform of each row (residues; length a power of two), in bit-reversed order."""
    count, size = rows.shape
    out = rows
    for powers in _twiddles(size, False):
        half = len(powers)
        pairs = out.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        new = np.empty_like(pairs)
        total = low + high
        new[:, :, 0] = np.minimum(total, total - _P)  # below zero wraps to a huge number
        new[:, :, 1] = (low + (_P - high)) * powers % _P
        out = new.reshape(count, size)
    return out


def backward(rows: np.ndarray) -> np.ndarray:
    """Undoes ``forward``."""
    count, size = rows.shape
    out = rows
    for powers in reversed(_twiddles(size, True)):
        half = len(powers)
        pairs = out.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * powers % _P
        new = np.empty_like(pairs)
        total = low + high
        new[:, :, 0] = np.minimum(total, total - _P)
        total = low + (_P - high)
        new[:, :, 1] = np.minimum(total, total - _P)
        out = new.reshape(count, size)
    return out * np.uint64(pow(size, -1, PRIME)) % _P


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row and shift t, the sum over j of (window[t + j] - block[j])**2 modulo the prime.

    ``blocks`` has rows of B residues, ``windows`` rows of 2 B; shifts are 0 to B - 1. The sums of
    squares are running totals, the products one cyclic convolution of length 2 B.
    """
    width = blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, width + 1 :] = blocks[:, :0:-1]
    products = backward(forward(turned) * forward(windows) % _P)[:, :width]
    squares = np.cumsum(windows * windows % _P, axis=1)
    own = (blocks * blocks % _P).sum(axis=1, keepdims=True)
    ahead = squares[:, width - 1 : 2 * width - 1].copy()
    ahead[:, 1:] -= squares[:, : width - 1]
    return (ahead + own + (_P - products) * np.uint64(2)) % _P
