"""Sampling of segmentations on the piece lattice, in numpy over many words at once.

A vocabulary's pieces hold spaces only at their start, so a text falls into chunks (spaces and the
word after them, or a line break) that are segmented independently. For the distinct chunks of a
batch, all pieces at all places are found with rolling hashes (edges of the lattice), forward
filtering sums the weights of all segmentations up to each place, and backward sampling draws, for
each occurrence of a chunk, one edge after the other from its end with the probabilities that the
sums give. Random numbers are hashes of (row seed, chunk's place, step), so a row's segmentation
depends on its key and text alone.
"""

from __future__ import annotations

import re

import numpy as np

from .superminhash import mixed

SPACE, MARK = " ", "▁"
CHUNKS = re.compile(r"\n| +[^ \n]*|[^ \n]+")
#: Longer chunks are filtered in logarithms, one by one.
LONG_CHUNK = 48
_BASE = np.uint64(0x100000001B3 * 0x9E3779B1 & (1 << 64) - 1 | 1)
_SLOT_BITS = 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces as text with spaces, their weights, and byte pieces for all else."""

    def __init__(self, pieces: list[str], scores: list[float], special: list[bool], bytes_at: list[int], theta: float):
        self.byte_ids = np.array(bytes_at, np.int32)
        self.text = [b""] * len(pieces)
        for i, p in enumerate(pieces):
            if not special[i]:
                self.text[i] = p.replace(MARK, SPACE).encode()
        for value, i in enumerate(bytes_at):
            self.text[i] = bytes([value])
        known = {p.replace(MARK, SPACE): i for i, p in enumerate(pieces) if not special[i] and i not in set(bytes_at)}
        bad = [p for p in known if SPACE in p.lstrip(SPACE) or "\n" in p]
        if bad:
            raise ValueError(f"pieces with inner spaces: {bad[:3]}")
        self.known = known
        self.longest = max(map(len, known))
        # Models mark bare characters with enormous negative scores; they count as the last merge.
        floor = -float(len(pieces))
        self.log_weight = theta * np.maximum(np.array(scores), floor)
        self.weight = np.exp(self.log_weight)
        self.log_fallback = theta * (floor - 1000.0)
        self.fallback = float(np.exp(self.log_fallback))
        prefixes = {p[:n] for p in known for n in range(1, len(p))}
        entries = sorted(prefixes | set(known))
        keys = np.array([self._key(p) for p in entries], np.uint64)
        values = np.array([known.get(p, -1) for p in entries], np.int32)
        longer = np.array([p in prefixes for p in entries])
        if len(np.unique(keys)) != len(keys):
            raise ValueError("piece hashes collide")
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        first = np.concatenate([[True], slot[order][1:] != slot[order][:-1]])
        n = 1 << _SLOT_BITS
        self.slot_key, self.slot_at, self.crowded = np.zeros(n, np.uint64), np.full(n, -1, np.int32), np.zeros(n, bool)
        self.slot_key[slot[order[first]]] = keys[order[first]]
        self.slot_at[slot[order[first]]] = order[first]
        self.crowded[slot[order[~first]]] = True
        rest = order[~first][np.argsort(keys[order[~first]])]
        self.rest_key, self.rest_at = keys[rest], rest.astype(np.int32)
        self.values, self.longer = values, longer

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    @staticmethod
    def _key(piece: str) -> int:
        key = 0
        for c in piece:
            key = (key * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
        return key

    def entries(self, keys: np.ndarray) -> np.ndarray:
        """For each key its entry's number, -1 if there is none."""
        slot = self._slot(keys)
        at = np.where(self.slot_key[slot] == keys, self.slot_at[slot], -1)
        miss = np.flatnonzero((at < 0) & self.crowded[slot])
        if len(miss) and len(self.rest_key):
            place = np.minimum(np.searchsorted(self.rest_key, keys[miss]), len(self.rest_key) - 1)
            at[miss] = np.where(self.rest_key[place] == keys[miss], self.rest_at[place], -1)
        return at

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation, without the space that encoding puts before it."""
        return b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")[1:]


class Lattice:
    """The filtered lattice of distinct chunks: edges by end node, with cumulative probabilities.

    Node ``first[c] + i`` is the place after ``i`` characters of chunk ``c``.
    """

    def __init__(self, vocabulary: Vocabulary, chunks: list[str]):
        v = vocabulary
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n, total = len(chunks), int(lengths.sum())
        char_end = np.repeat(np.cumsum(lengths), lengths)  # of the chunk, for each character
        chunk = np.repeat(np.arange(n), lengths)
        node_of = np.arange(total) + chunk  # each chunk has one node more than characters
        self.first = np.cumsum(lengths) - lengths + np.arange(n)
        self.last = self.first + lengths
        key, at = np.zeros(total, np.uint64), np.arange(total)
        starts, sizes, ids, single = [], [], [], np.zeros(total, bool)
        for size in range(1, v.longest + 1):
            fits = at + size <= char_end[at]
            at, key = at[fits], key[fits]
            if not len(at):
                break
            key = key * _BASE + code[at + size - 1] + np.uint64(1)
            entry = v.entries(key)
            piece = np.where(entry >= 0, v.values[entry], -1)
            hit = piece >= 0
            starts.append(at[hit]), sizes.append(np.full(int(hit.sum()), size)), ids.append(piece[hit])
            if size == 1:
                single[at[hit]] = True
            go = (entry >= 0) & v.longer[entry]
            at, key = at[go], key[go]
        bare = np.flatnonzero(~single)  # characters that no piece spells are spelled in bytes
        starts.append(bare), sizes.append(np.ones(len(bare), np.int64)), ids.append(np.full(len(bare), -1))
        start, size, piece = np.concatenate(starts), np.concatenate(sizes), np.concatenate(ids).astype(np.int32)
        tail = node_of[start] + size
        order = np.argsort(tail, kind="stable")
        start, piece, tail = start[order], piece[order], tail[order].astype(np.int32)
        head = node_of[start].astype(np.int32)
        depth = np.minimum(tail - self.first[chunk[start]], LONG_CHUNK + 1).astype(np.uint8)
        alpha = np.zeros(total + n)
        alpha[self.first] = 1.0
        share = np.empty(len(head))
        weight = np.where(piece >= 0, v.weight[piece], v.fallback)
        new = np.concatenate([[True], tail[1:] != tail[:-1]]) if len(tail) else np.empty(0, bool)
        long = (lengths > LONG_CHUNK)[chunk[start]] if lengths.max(initial=0) > LONG_CHUNK else None
        by_depth = np.argsort(depth, kind="stable") if long is None else np.flatnonzero(~long)[np.argsort(depth[~long], kind="stable")]
        bounds = np.searchsorted(depth[by_depth], np.arange(1, LONG_CHUNK + 2))
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            e = by_depth[a:b]
            mass = alpha[head[e]] * weight[e]
            firsts = np.flatnonzero(new[e])
            sums = np.add.reduceat(mass, firsts)
            alpha[tail[e[firsts]]] = sums
            share[e] = mass / np.repeat(sums, np.diff(np.append(firsts, len(e))))
        if long is not None:
            self._filter_long(np.flatnonzero(long), head, tail, np.where(piece >= 0, v.log_weight[piece], v.log_fallback), share)
        self.head, self.piece = head, piece
        ends = np.flatnonzero(new)
        self.edge_from = np.zeros(total + n, np.int32)
        self.edge_from[tail[ends]] = ends
        # Cumulative probabilities of the edges into each node.
        running = np.cumsum(share)
        before = np.where(ends > 0, running[ends - 1], 0.0)
        count = np.diff(np.append(ends, len(tail)))
        self.cumulative = running - np.repeat(before, count)
        # The last edge into a node takes what is left, whatever the sums' rounding.
        self.cumulative[ends + count - 1] = 2.0
        self.code_at = np.full(total + n, 0, np.uint32)
        self.code_at[node_of] = code.astype(np.uint32)

    def _filter_long(self, edges, head, tail, log_w, share):
        order = edges[np.argsort(tail[edges], kind="stable")]
        log_alpha: dict[int, float] = {}
        new = np.flatnonzero(np.concatenate([[True], tail[order][1:] != tail[order][:-1]]))
        for e in np.split(order, new[1:]):
            mass = np.array([log_alpha.get(h, 0.0) for h in head[e].tolist()]) + log_w[e]
            top = mass.max()
            total = top + float(np.log(np.exp(mass - top).sum()))
            log_alpha[int(tail[e[0]])] = total
            share[e] = np.exp(mass - total)

    def sample(self, chunk: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One segmentation for each occurrence: (occurrence, piece or -1, code of the byte-spelled character), in order.

        ``seed`` has 64 random bits for each occurrence.
        """
        node, live, step = self.last[chunk], np.arange(len(chunk)), 0
        root = self.first[chunk]
        who, what, where = [], [], []
        while len(live):
            at = node[live]
            edge = self.edge_from[at]
            u = (mixed(seed[live] + np.uint64(step * int(_GOLD) & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) / 9007199254740992.0
            on = np.flatnonzero(self.cumulative[edge] <= u)
            while len(on):
                edge[on] += 1
                on = on[self.cumulative[edge[on]] <= u[on]]
            who.append(live), what.append(self.piece[edge]), where.append(self.head[edge])
            node[live] = self.head[edge]
            live = live[node[live] > root[live]]
            step += 1
        if not who:
            empty = np.empty(0, np.int64)
            return empty, empty, empty
        who, what, where = np.concatenate(who), np.concatenate(what), np.concatenate(where)
        order = np.lexsort((where - self.first[chunk[who]], who))
        return who[order], what[order], self.code_at[where[order]]


class Sampler:
    """Segments batches of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __call__(self, texts: list[str], seeds: list[int]) -> list[np.ndarray]:
        distinct: dict[str, int] = {}
        number = []
        counts = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = CHUNKS.findall(SPACE + text) if text else []
            counts[i] = len(found)
            number += [distinct.setdefault(c, len(distinct)) for c in found]
        if not number:
            return [np.empty(0, np.int32) for _ in texts]
        chunk = np.array(number, np.int64)
        row = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(chunk)) - np.repeat(np.cumsum(counts) - counts, counts)
        seed = mixed(np.array(seeds, np.uint64)[row] + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        lattice = Lattice(self.vocabulary, list(distinct))
        who, piece, code = lattice.sample(chunk, seed)
        spelled = np.flatnonzero(piece < 0)
        if len(spelled):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in code[spelled].tolist()]
            repeat = np.ones(len(piece), np.int64)
            repeat[spelled] = [len(r) for r in raw]
            at = np.cumsum(repeat) - repeat
            who = np.repeat(who, repeat)
            piece = np.repeat(piece, repeat)
            piece[np.concatenate([np.arange(at[i], at[i] + len(r)) for i, r in zip(spelled.tolist(), raw)])] = self.vocabulary.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.searchsorted(row[who], np.arange(1, len(texts)))
        return np.split(piece.astype(np.int32), ends)
