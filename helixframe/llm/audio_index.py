"""An inverted index of the integers of some recordings, and offset histograms of what others find in it, in numpy.

Each recording of a block is filed under its integers. Another asks for each of its own and for those
that differ in a few bits; what it finds is counted by recording and offset, and offsets that several
integers agree on are verified, with their neighbours, by the share of differing bits. Integers that
a fixed share of the block holds tell little and are left out; recordings that hardly have others are
``plain``, and the caller searches those at every offset.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

#: Bits in which an integer that is asked for may differ.
FLIPS = 1
#: An integer is frequent if more than one in FREQUENT recordings of a block hold it, and more than LEAST_FREQUENT.
FREQUENT, LEAST_FREQUENT = 50, 16
#: An integer that a recording has in more runs than this, as in a loop, does not count for it.
REPEATS = 64
#: A recording is plain if fewer than one in LEAST_RARE of its integers count and are not frequent.
LEAST_RARE = 4
#: Integers that must agree on an offset.
LEAST_HITS = 2
#: Integers that are asked for at once, places that are counted at once and integers that are compared at once, about.
ASKED, COUNTED, COMPARED = 1 << 20, 1 << 21, 1 << 20
#: Bits of the filter that most integers stop at.
FILTER_BITS = 24


def filed_places(ints: np.ndarray) -> np.ndarray:
    """Places that a recording is filed under: the first of each run of an integer, unless it has over REPEATS runs."""
    first = np.flatnonzero(np.concatenate([[True], ints[1:] != ints[:-1]])) if len(ints) else np.empty(0, np.int64)
    _, which, runs = np.unique(ints[first], return_inverse=True, return_counts=True)
    return first[runs[which] <= REPEATS]


def errors_at(a: list, b: list, i: np.ndarray, j: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bit error, places) where b[j] is laid over a[i] from ``offset``; error 1 where they don't meet."""
    m, n = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    low = np.maximum(0, offset)
    places = np.maximum(np.minimum(m[i], offset + n[j]) - low, 0)
    from_a, from_b = (np.cumsum(m) - m)[i] + low, (np.cumsum(n) - n)[j] + low - offset
    error, until = np.ones(len(i)), np.cumsum(places)
    at = 0
    while at < len(i):
        stop = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + COMPARED, "right")))
        some = at + np.flatnonzero(places[at:stop])
        if len(some):
            size = places[some]
            begin = np.cumsum(size) - size
            step = np.arange(size.sum()) - np.repeat(begin, size)
            differ = flat_a[np.repeat(from_a[some], size) + step] ^ flat_b[np.repeat(from_b[some], size) + step]
            error[some] = np.add.reduceat(np.bitwise_count(differ), begin, dtype=np.int64) / (32 * size)
        at = stop
    return error, places


class Index:
    """Recordings (arrays of integers) filed under their integers; ``plain`` marks those that are not."""

    def __init__(self, prints: list, flips: int = FLIPS):
        self.prints = prints
        self.masks = np.array([sum(1 << b for b in bits) for n in range(flips + 1) for bits in combinations(range(32), n)], np.uint32)
        held, count = np.unique(np.concatenate([np.unique(p) for p in prints] or [np.empty(0, np.uint32)]), return_counts=True)
        self.frequent = held[count > max(LEAST_FREQUENT, len(prints) / FREQUENT)]
        places = [self._rare_places(p) for p in prints]
        self.plain = np.array([self._is_plain(p, x) for p, x in zip(prints, places)], bool)
        places = [x[:0] if plain else x for x, plain in zip(places, self.plain)]
        v = np.concatenate([p[x] for p, x in zip(prints, places)] or [np.empty(0, np.uint32)])
        order = np.argsort(v, kind="stable")
        self.owner = np.repeat(np.arange(len(prints)), [len(x) for x in places])[order]
        self.place = (np.concatenate(places) if places else np.empty(0, np.int64))[order]
        self.keys, self.first, self.size = np.unique(v[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._spot(self.keys)] = True

    @staticmethod
    def _spot(v: np.ndarray) -> np.ndarray:
        return v * np.uint32(0x9E3779B1) >> np.uint32(32 - FILTER_BITS)

    def _rare_places(self, ints: np.ndarray) -> np.ndarray:
        place = filed_places(ints)
        return place[~np.isin(ints[place], self.frequent)] if len(self.frequent) else place

    @staticmethod
    def _is_plain(ints: np.ndarray, rare: np.ndarray) -> bool:
        return len(rare) * LEAST_RARE < len(ints)

    def is_plain(self, ints: np.ndarray) -> bool:
        """Whether another recording is plain to this index."""
        return self._is_plain(ints, self._rare_places(ints))

    def agreed(self, found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(filed recording, place in ``found``, offset) wherever LEAST_HITS integers or more agree."""
        lengths = np.array([len(f) for f in found], np.int64)
        at, parts = 0, [(np.empty(0, np.int64),) * 3]
        until = np.cumsum(lengths)
        while at < len(found):
            stop = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + ASKED // len(self.masks), "right")))
            parts += self._histogram(found[at:stop], lengths[at:stop], at)
            at = stop
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _histogram(self, found: list, lengths: np.ndarray, base: int):
        flat = np.concatenate(found)
        # A mask at a time, so that a long recording holds one copy of its integers.
        asks, keys = [], []
        for mask in self.masks:
            v = flat ^ mask
            some = np.flatnonzero(self.filter[self._spot(v)])
            key = np.searchsorted(self.keys, v[some])
            real = (key < len(self.keys)) & (self.keys[np.minimum(key, len(self.keys) - 1)] == v[some]) if len(self.keys) else np.zeros(len(some), bool)
            asks.append(some[real]), keys.append(key[real])
        ask, key = np.concatenate(asks), np.concatenate(keys)
        order = np.argsort(ask, kind="stable")
        ask, key = ask[order], key[order]
        of = np.repeat(np.arange(len(found)), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        span, hits = int(lengths.max(initial=0)), np.cumsum(self.size[key])
        # Whole recordings at a time, as all their places belong to one histogram.
        ends = np.searchsorted(of[ask], np.arange(len(found)), "right")
        at = 0
        while at < len(found):
            low = ends[at - 1] if at else 0
            done = hits[low - 1] if low else 0
            stop = at + 1
            while stop < len(found) and (hits[ends[stop] - 1] if ends[stop] else 0) - done <= COUNTED:
                stop += 1
            a, k = ask[low : ends[stop - 1]], key[low : ends[stop - 1]]
            size = self.size[k]
            where = np.repeat(self.first[k] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            asked = np.repeat(a, size)
            offset = self.place[where] - place[asked]
            wide = span + int(self.place.max(initial=0)) + 1
            cell, n = np.unique((self.owner[where] * len(found) + of[asked]) * wide + offset + span, return_counts=True)
            pair, offset = np.divmod(cell[n >= LEAST_HITS], wide)
            yield pair // len(found), pair % len(found) + base, offset - span
            at = stop

    def matches(self, found: list, largest_error: float, least_overlap: float) -> list:
        """(filed recording, place in ``found``, offset, bit error) of the best agreed offset of each pair that aligns.

        The nearer offset wins among equal errors, the negative one among equally near ones.
        """
        mine, other, offset = self.agreed(found)
        if not len(mine):
            return []
        tried = np.unique(np.stack([np.tile(mine, 3), np.tile(other, 3), np.concatenate([offset - 1, offset, offset + 1])]), axis=1)
        mine, other, offset = tried
        error, places = errors_at(self.prints, found, mine, other, offset)
        shorter = np.minimum(np.array([len(x) for x in self.prints])[mine], np.array([len(x) for x in found])[other])
        good = np.flatnonzero((places > 0) & (places >= least_overlap * shorter) & (error <= largest_error))
        order = good[np.lexsort((offset[good], np.abs(offset[good]), error[good], other[good], mine[good]))]
        pair = mine[order] * len(found) + other[order]
        best = order[np.unique(pair, return_index=True)[1]]
        return list(zip(mine[best].tolist(), other[best].tolist(), offset[best].tolist(), error[best].tolist()))
