"""Shingle sets and SuperMinHash signatures of single texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
SLOTS = 120
#: Rows of a band: 24 bands of 5 miss a pair of similarity 0.85 with probability below 1e-6.
BAND_ROWS = 5
#: Words whose hashes are kept between texts.
KNOWN_WORDS = 100_000

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each value."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Maps a text to the sorted distinct 64-bit hashes of its shingles."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and the six white spaces
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(h))
        n = len(h) - width + 1
        key = np.full(n, len(h) if len(h) < self.width else 0, np.uint64)
        for i in range(width):
            key = mixed(key * np.uint64(_STEP) + h[i : i + n])
        return np.unique(key)


def signature(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of a non-empty set of 64-bit hashes: ``slots`` values, each step plus a fraction.

    In step j every element takes the next slot of its own random permutation (Fisher-Yates) and
    offers it j plus a random fraction. When every slot's value is at most j + 1, later steps can't
    lower any and the rest is skipped.
    """
    best = np.full(slots, np.inf)
    order = None
    rows = np.arange(len(elements))
    first = None
    for j in range(slots):
        z = mixed(elements + np.uint64((j + 1) * _STEP & _MASK))
        pick = j + ((z & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        value = j + (z >> np.uint64(32)).astype(np.float64) / 4294967296.0
        if j == 0:
            first, slot = pick, pick
        else:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.int16), (len(elements), 1))
                order[rows, first] = 0
                order[:, 0] = first
            slot = order[rows, pick]
            order[rows, pick] = order[:, j]
            order[:, j] = slot
        np.minimum.at(best, slot, value)
        if best.max() <= j + 1:
            break
    return best


def bands(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One signed 64-bit key for each band, different bands having different keys."""
    parts = sig.view(np.uint64).reshape(-1, rows)
    key = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for i in range(rows):
        key = mixed(key * np.uint64(_STEP) + parts[:, i])
    return key.view(np.int64)
