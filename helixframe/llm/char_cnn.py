"""A small character convolutional network in numpy: embedding, convolution, maxima of three regions, two layers.

The convolution does not depend on the candidate, so it runs once over a text; a candidate then takes
the maximum of each filter over the characters before it, over all of its own, and over those after.
"""

from __future__ import annotations

import numpy as np

BEFORE, AFTER = 24, 8
WIDTH, EMBED, FILTERS, HIDDEN = 5, 8, 24, 16
HALO = WIDTH // 2
#: Examples for the fit hold so much of a candidate; scores read all of it.
FIT_INSIDE = 64
BLOCK = 4096

#: Class of a character: one for each printable ASCII character, one for the rest, 0 outside the text.
CLASSES, REST = 97, 96
_CLASS = np.full(128, REST, np.uint8)
_CLASS[32:127] = np.arange(1, 96)
_LETTER = np.zeros(CLASSES, bool)
_LETTER[[c - 31 for c in (*range(65, 91), *range(97, 123))]] = True


def classes(text: str) -> np.ndarray:
    """A class for each code point."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(codes, 127)]


def snippet(x: np.ndarray, start: int, end: int) -> tuple[bytes, int]:
    """(classes around a candidate, length of its part inside) for the fit."""
    inside = min(end - start, FIT_INSIDE)
    lo, hi = start - BEFORE - HALO, start + inside + AFTER + HALO
    part = x[max(0, lo) : hi].tobytes()
    return (b"\0" * max(0, -lo) + part).ljust(hi - lo, b"\0"), inside


def windows(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``stacked`` snippets of many candidates, with the lengths of their parts inside."""
    inside = np.minimum(ends - starts, FIT_INSIDE)
    place = np.arange(BEFORE + FIT_INSIDE + AFTER + 2 * HALO)[None] - (BEFORE + HALO)
    at = starts[:, None] + place
    read = (at >= 0) & (at < len(x)) & (place < (inside + AFTER + HALO)[:, None])
    return np.where(read, x[np.clip(at, 0, max(len(x) - 1, 0))], 0).astype(np.uint8), inside


def stacked(snippets: list[bytes]) -> np.ndarray:
    """Snippets as rows of one length, 0 at their ends."""
    length = BEFORE + FIT_INSIDE + AFTER + 2 * HALO
    return np.frombuffer(b"".join(s.ljust(length, b"\0") for s in snippets), np.uint8).reshape(len(snippets), length)


def redrawn(x: np.ndarray, rng) -> np.ndarray:
    """Rows whose letters before the candidate are drawn anew from all such letters, so that names don't tell."""
    out = x.copy()
    before = out[:, : BEFORE + HALO]
    letters = _LETTER[before]
    if letters.any():
        before[letters] = rng.choice(before[letters], int(letters.sum()))
    return out


def _regions(inside: np.ndarray, length: int) -> np.ndarray:
    """Mask (rows, regions, places of the convolution): before, inside, after."""
    at = np.arange(length)[None]
    end = (BEFORE + inside)[:, None]
    return np.stack([np.broadcast_to(at < BEFORE, (len(inside), length)), (at >= BEFORE) & (at < end), (at >= end) & (at < end + AFTER)], 1)


def _head(p: dict, top: np.ndarray) -> tuple:
    m = np.maximum(top + np.tile(p["bias"], 3), 0)
    h = np.maximum(m @ p["w1"] + p["b1"], 0)
    return h @ p["w2"] + p["b2"], m, h


def forward(p: dict, x: np.ndarray, inside: np.ndarray) -> tuple:
    """Scores of stacked snippets, with what the gradient needs."""
    view = np.lib.stride_tricks.sliding_window_view(p["embed"][x], WIDTH, axis=1)
    a = view.transpose(0, 1, 3, 2).reshape(len(x), x.shape[1] - WIDTH + 1, WIDTH * EMBED)
    c = a @ p["filters"]
    mask = _regions(inside, c.shape[1])
    at = np.stack([np.where(mask[:, r, :, None], c, np.float32(-1e9)).argmax(1) for r in range(3)], 1)
    rows = np.arange(len(x))[:, None, None]
    top = c[rows, at, np.arange(FILTERS)]
    z, m, h = _head(p, top.reshape(len(x), 3 * FILTERS))
    return z, (a, at, m, h)


def logits(p: dict, x: np.ndarray, inside: np.ndarray, batch: int = 256) -> np.ndarray:
    return np.concatenate([forward(p, x[i : i + batch], inside[i : i + batch])[0] for i in range(0, len(x), batch)] or [np.empty(0)])


def started(seed: int = 11) -> dict:
    """A network to begin with."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, (2 / shape[0]) ** 0.5, shape).astype(np.float32)
    p = {"embed": rng.normal(0, 0.5, (CLASSES, EMBED)).astype(np.float32), "filters": draw(WIDTH * EMBED, FILTERS), "bias": np.zeros(FILTERS, np.float32)}
    return p | {"w1": draw(3 * FILTERS, HIDDEN), "b1": np.zeros(HIDDEN, np.float32), "w2": draw(HIDDEN), "b2": np.zeros((), np.float32)}


def flat(p: dict) -> np.ndarray:
    """All parameters of a network in one row."""
    return np.concatenate([v.ravel() for v in p.values()])


def shaped(values: np.ndarray) -> dict:
    """The network of a row of parameters."""
    p, at = {}, 0
    for k, v in started().items():
        p[k] = np.asarray(values[at : at + v.size], np.float32).reshape(v.shape)
        at += v.size
    return p


class Adam:
    """A network's fit; ``step`` reads rows, half of them with their letters before redrawn."""

    def __init__(self, p: dict, rng, rate: float = 4e-3):
        self.p, self.rng, self.rate, self.steps = dict(p), rng, rate, 0
        self.first, self.second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, x: np.ndarray, inside: np.ndarray, slope) -> None:
        """``slope`` gives the loss's derivative by each row's score."""
        p = self.p
        seen = np.where((self.rng.random(len(x)) < 0.5)[:, None], redrawn(x, self.rng), x)
        z, (a, at, m, h) = forward(p, seen, inside)
        d = slope(z).astype(np.float32)
        dh = np.outer(d, p["w2"]) * (h > 0)
        dm = (dh @ p["w1"].T) * (m > 0)
        rows = np.arange(len(x))[:, None, None]
        picked = a[rows, at].reshape(len(x), 3 * FILTERS, -1)  # the patch that each maximum came from
        by_filter = np.einsum("bf,bfk->fk", dm, picked).reshape(3, FILTERS, -1).sum(0).T
        g = {"w2": h.T @ d, "b2": d.sum(), "w1": m.T @ dh, "b1": dh.sum(0), "bias": dm.sum(0).reshape(3, FILTERS).sum(0), "filters": by_filter}
        da = dm.reshape(len(x), 3, FILTERS, 1) * p["filters"].T[None, None]
        read = np.stack([seen[rows, at + k] for k in range(WIDTH)], 3).ravel()
        da = da.reshape(len(read), EMBED)
        g["embed"] = np.stack([np.bincount(read, da[:, i], CLASSES) for i in range(EMBED)], 1).astype(np.float32)
        self.steps += 1
        for k, v in g.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * v
            self.second[k] = 0.999 * self.second[k] + 0.001 * v * v
            p[k] = (p[k] - self.rate * (self.first[k] / (1 - 0.9**self.steps)) / (np.sqrt(self.second[k] / (1 - 0.999**self.steps)) + 1e-8)).astype(np.float32)


def fit(x: np.ndarray, inside: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 11) -> dict:
    """Minimise the class-balanced log loss with Adam; every other row has its letters before redrawn."""
    rng = np.random.default_rng(seed)
    adam = Adam(started(seed), rng, rate)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            adam.step(x[part], inside[part], lambda z, part=part: weight[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part))
    return adam.p


def _tables(p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the first two, the next two and the last of the convolution's characters add to each filter, by classes."""
    one = [p["embed"] @ p["filters"][k * EMBED : (k + 1) * EMBED] for k in range(WIDTH)]
    two = [(one[k][:, None] + one[k + 1][None]).reshape(CLASSES * CLASSES, FILTERS) for k in (0, 2)]
    return *two, one[4]


def _convolved(tables: tuple, x: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Filters (columns) at the places lo to hi of a text; places outside it are of class 0."""
    a, b = lo - HALO, hi + HALO
    part = np.zeros(b - a, np.intp)
    part[max(0, -a) : max(0, -a) + max(0, min(b, len(x)) - max(0, a))] = x[max(0, a) : min(b, len(x))]
    pair = part[:-1] * CLASSES + part[1:]
    n = hi - lo
    c = tables[0].take(pair[:n], axis=0)
    c += tables[1].take(pair[2 : n + 2], axis=0)
    c += tables[2].take(part[4 : n + 4], axis=0)
    return c


def _longest(c: np.ndarray, four: np.ndarray, eight: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Maxima of the places [s, e), from those of 4 and 8 places from each place on."""
    n = e - s
    short = n < 8
    top = np.empty((len(s), FILTERS), np.float32)
    top[short] = np.maximum(four.take(s[short], axis=0), four.take(np.maximum(e[short] - 4, 0), axis=0))
    which = np.flatnonzero(~short)
    top[which] = np.maximum(eight.take(s[which], axis=0), eight.take(e[which] - 8, axis=0))
    at = 8
    while len(which := which[n[which] > at + 8]) and at < 64:
        top[which] = np.maximum(top[which], eight.take(s[which] + at, axis=0))
        at += 8
    for i in (*which, *np.flatnonzero(n < 4)):
        top[i] = c[s[i] : e[i]].max(0)
    return top


def scores(p: dict, x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scores of the candidates [start, end) of a text's classes, which come in order and don't overlap."""
    found, i, tables = [np.empty(0)], 0, _tables(p)
    while i < len(starts):
        j = int(np.searchsorted(starts, starts[i] + BLOCK))
        s, e = starts[i:j], ends[i:j]
        lo, cut = int(s[0]) - BEFORE, np.minimum(e, s[0] + 2 * BLOCK)
        c = _convolved(tables, x, lo, int(cut[-1]) + AFTER + 1)
        two = np.maximum(c[:-1], c[1:])
        four = np.maximum(two[:-2], two[2:])
        eight = np.maximum(four[:-4], four[4:])
        inside = _longest(c, four, eight, s - lo, cut - lo)
        before = np.maximum.reduce([eight.take(s - lo - back, axis=0) for back in range(8, BEFORE + 1, 8)])
        after = eight.take(cut - lo, axis=0)
        if cut[-1] < e[-1]:  # the last candidate is longer than what was read
            for a in range(int(cut[-1]), int(e[-1]), BLOCK):
                more = _convolved(tables, x, a, min(a + BLOCK, int(e[-1])))
                inside[-1] = np.maximum(inside[-1], more.max(0))
            after[-1] = _convolved(tables, x, int(e[-1]), int(e[-1]) + AFTER).max(0)
        found.append(_head(p, np.concatenate([before, inside, after], 1))[0])
        i = j
    return np.concatenate(found)


def calibrate(z: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Platt scaling: (a, b) of 1 / (1 + exp(-(a z + b))), by gradient descent on smoothed labels."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.abs(z).max()), 1e-6) if len(z) else 1.0
    a, b, u = 1.0, 0.0, z / scale
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(a * u + b))) - t
        a, b = a - 5.0 * float((e * u).mean()), b - 5.0 * float(e.mean())
    return a / scale, b


def threshold_for_recall(p: np.ndarray, y: np.ndarray, recall: float) -> float:
    """The largest threshold at which so many of the positives score at least it."""
    positive = np.sort(p[y == 1])[::-1]
    return float(positive[min(len(positive) - 1, int(np.ceil(recall * len(positive))) - 1)])
