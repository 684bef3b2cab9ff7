"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text becomes a sparse vector: its distinct lower-cased words hashed to buckets, weighted by the
logarithm of their counts and scaled to length one, and one-hot bands of structure statistics
(symbols, capitals, repeated lines, word lengths, ...) and of metadata (the declared number of
characters and how far it is from the text's). Its score is

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],

all pairs of features in time linear in their number, then a logistic link.

The model is fitted with Adam on at most ``max_rows`` labelled documents, those first in an order
by a hash of their ids (a documented bound; the model, a few hundred kB, is what tasks receive).
Every document is scored over its whole text. Labels, language, source and id are no inputs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

BUCKETS = 1 << 13
FACTORS = 6
MAX_ROWS = 8000
#: Bands of each statistic: it lights the feature of the band it falls in.
STATISTICS = (
    ("words", (1, 5, 10, 20, 50, 100, 300, 1000, 3000, 10000)),
    ("symbols per word", (0.001, 0.01, 0.03, 0.1, 0.2, 0.4, 0.8)),
    ("pipes per word", (0.001, 0.01, 0.05, 0.1, 0.2, 0.4)),
    ("exclamation marks per word", (0.001, 0.01, 0.05, 0.1, 0.3, 0.6)),
    ("capital letters", (0.005, 0.01, 0.02, 0.03, 0.05, 0.1, 0.3, 0.6)),
    ("digits", (0.001, 0.005, 0.02, 0.05, 0.1, 0.3)),
    ("characters per word", (3, 4, 5, 5.5, 6, 6.5, 7, 8, 10, 15)),
    ("distinct words", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
    ("repeated lines", (0.001, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8)),
    ("words per line", (2, 4, 8, 12, 20, 40, 80, 200)),
    ("sentence ends per word", (0.01, 0.03, 0.05, 0.08, 0.12, 0.2, 0.4)),
    ("most frequent word", (0.02, 0.04, 0.06, 0.08, 0.12, 0.2, 0.4)),
    ("declared characters", (1, 100, 300, 1000, 3000, 10000, 30000)),
    ("declared less actual", (-0.5, -0.01, 0.01, 0.5)),
)
STRUCTURE = sum(len(bands) + 1 for _, bands in STATISTICS)
DIMENSION = BUCKETS + STRUCTURE
_FIRST = np.cumsum([BUCKETS] + [len(bands) + 1 for _, bands in STATISTICS])[:-1]
_BANDS = [np.asarray(bands) for _, bands in STATISTICS]
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_DIGITS = re.compile(r"[0-9]+")


def features(text: str, declared) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, values) of the non-zero features of a text and its declared number of characters."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = Counter(raw.lower().split())
    n, length = sum(counts.values()), len(text)
    # Words that share a bucket are one feature, which has no pair with itself.
    index, place = np.unique(np.fromiter((zlib.crc32(w) for w in counts), np.int64, len(counts)) % BUCKETS, return_inverse=True)
    value = np.bincount(place, np.log1p(np.fromiter(counts.values(), np.float64, len(counts))), len(index)).astype(np.float64)
    value /= max(np.sqrt((value * value).sum()), 1e-9)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    per = 1 / max(n, 1)
    stats = (
        n,
        sum(text.count(c) for c in "#*$%&<>") * per,
        text.count("|") * per,
        text.count("!") * per,
        sum(map(len, _CAPITALS.findall(text))) / max(length, 1),
        sum(map(len, _DIGITS.findall(text))) / max(length, 1),
        length * per,
        len(counts) * per,
        1 - len(set(lines)) / max(len(lines), 1),
        n / max(len(lines), 1),
        (text.count(".") + text.count("?")) * per,
        max(counts.values(), default=0) * per,
        declared or 0,
        ((declared or 0) - length) / max(length, 1),
    )
    lit = [first + int(np.searchsorted(bands, s, "right")) for first, bands, s in zip(_FIRST, _BANDS, stats)]
    ones = np.full(len(lit), len(lit) ** -0.5)
    return np.concatenate([index, lit]), np.concatenate([value, ones])


def raw_score(model: dict, index: np.ndarray, value: np.ndarray) -> float:
    v = model["v"][index] * value[:, None]
    pairs = 0.5 * float((v.sum(0) ** 2).sum() - (v * v).sum())
    return float(model["w0"] + model["w"][index] @ value + pairs)


def probability(model: dict, index: np.ndarray, value: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(raw_score(model, index, value), -30, 30))))


def fit(rows: list, labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> dict:
    """Minimise the log loss over (indexes, values) rows with Adam on the touched coordinates."""
    rng = np.random.default_rng(seed)
    p = {"w": np.zeros(DIMENSION), "v": rng.normal(0, 0.05, (DIMENSION, FACTORS))}
    m = {k: np.zeros_like(x) for k, x in p.items()}
    s = {k: np.zeros_like(x) for k, x in p.items()}
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    w0, step = float(np.log(share / (1 - share))), 0
    for _ in range(epochs if len(rows) else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            sizes = np.array([len(rows[i][0]) for i in part])
            index, x = (np.concatenate([rows[i][k] for i in part]) for k in (0, 1))
            row, starts = np.repeat(np.arange(len(part)), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            vx = p["v"][index] * x[:, None]
            total = np.add.reduceat(vx, starts)
            z = w0 + np.add.reduceat(p["w"][index] * x, starts) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            w0 -= 0.5 * rate * float(error.sum())
            touched, place = np.unique(index, return_inverse=True)
            per_feature = error[row] * x
            grad = {"w": np.zeros(len(touched)), "v": np.zeros((len(touched), FACTORS))}
            np.add.at(grad["w"], place, per_feature)
            np.add.at(grad["v"], place, per_feature[:, None] * (total[row] - vx))
            step += 1
            for k, g in grad.items():
                g += decay * p[k][touched]
                m[k][touched] = 0.9 * m[k][touched] + 0.1 * g
                s[k][touched] = 0.999 * s[k][touched] + 0.001 * g * g
                p[k][touched] -= rate * (m[k][touched] / (1 - 0.9**step)) / (np.sqrt(s[k][touched] / (1 - 0.999**step)) + 1e-8)
    return {"w0": w0, "w": p["w"].astype(np.float32), "v": p["v"].astype(np.float32)}


def held_out(id_col) -> F.Column:
    """Rows that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, length_col: str, label_col: str, max_rows: int) -> tuple[list, np.ndarray]:
    """Features and labels of the first ``max_rows`` labelled documents by a hash of their ids."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("doc")).agg(F.min(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc"), "doc").limit(max_rows)
    )
    # At most max_rows ids, so that they can be sent to every task.
    known = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(length_col).cast("long").alias("declared")).join(F.broadcast(chosen), "doc")

    def make():
        def row(doc, text, declared, label):
            index, value = features(text, declared)
            yield doc, label, index.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()

        return row

    kind = known.schema["doc"].dataType.simpleString()
    found = map_texts(known.select("doc", "text", "declared", "label"), "doc", "text", f"doc {kind}, label int, idx binary, val binary", make, ("declared", "label"))
    # Ids may repeat, so the bound is held on the rows too.
    got = sorted(found.orderBy(F.xxhash64("doc"), "doc", "idx", "val").limit(max_rows).toLocalIterator(), key=lambda r: (r["doc"], bytes(r["idx"]), bytes(r["val"])))
    rows = [(np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float32).astype(np.float64)) for r in got]
    return rows, np.array([r["label"] for r in got], np.float64)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", label_col: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    """The fitted model. Without labelled rows its factors are random and it scores every text about 0.5.

    Null labels and ids are left out; of several labels of an id the smallest counts. At most
    ``max_rows`` rows are fitted, whatever the table's size; each is read whole.
    """
    return fit(*training_rows(docs, labels, id_col, text_col, length_col, label_col, max_rows))


def score_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", threshold: float = 0.3) -> DataFrame:
    """(doc, held_out, score, predicted) for each row of ``docs``.

    Null and empty texts are scored as texts without words, null lengths as 0; texts of any length
    are read whole. Rows with a null id count as held out; ids keep their type. Repeated rows give a
    row each; other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def row(doc, text, declared):
            yield doc, probability(known, *features(text, declared))

        return row

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(length_col).cast("long").alias("declared"))
    found = map_texts(rows, "doc", "text", f"doc {rows.schema['doc'].dataType.simpleString()}, score double", make, ("declared",))
    return found.select("doc", held_out("doc").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
