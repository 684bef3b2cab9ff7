"""Secret scans: base rules and character convolutional networks over every candidate.

Base rules find assigned secrets, access keys and long hexadecimal runs. Candidates are all runs of
6 key characters or more, as short as an assigned value may be. A candidate in which a base finding
ends is a labelled positive. Labelled negatives are candidates that personal data (addresses, cards,
phone and IP numbers) overlap and those without any letter, such as dates, sums and dotted quads. The
rest is open; other parts of findings, such as the names of assigned keys, are neither.

Texts are of two halves by a hash, copies of the same. A network for each half is fitted on every
candidate of its texts, open ones as negatives, in units of texts that the table's rows make up,
however they are stored: each unit fits the networks of the last round further, and their mean is the
next round's. A table of many units has each in one round, a smaller one is read in every round. The
loss is 0 beyond a margin, so a step scores the next open candidates of the unit and has gradients
only of those within it. Secrets that no rule lists have names of their own, so the letters before a
candidate are redrawn in half of what the fit reads and, once more, of what it is judged on. Open
candidates may be such secrets, so after the first round those that the other half's network calls a
secret are no negatives; labelled negatives always are.

Each network is judged on and scans the half that it has not read: all of that half's labelled
candidates calibrate its probabilities (Platt), all its findings set the threshold, the highest that
still recalls ``recall`` of them. The networks read every open candidate of every text, and those from
the threshold on are added. Labelled negatives are never added.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.shared import temporary

from . import char_cnn
from .common import arrow_schema, map_text_groups, materialize
from .pii import SPAN
from .spans import SECRET, personal, secrets

LEARNED = "learned"
KINDS = (*SECRET, LEARNED)
RECALL = 0.95
#: Rounds of the fit, characters of a unit, its least steps; a step's positives or labelled negatives, most open candidates it scores.
ROUNDS, UNIT_CHARS, STEPS, LABELLED, MOST = 4, 1 << 23, 60, 32, 4096
#: Parameters are summed in whole parts of 1 / SCALE.
SCALE = 1 << 24
LEAST_CHARS = 6

KEY_CHARACTERS = "A-Za-z0-9+/_.=-"
#: By character class: key characters, digits, letters.
_KEY, _DIGIT, _LETTER = (np.array([bool(c >= 32 and re.fullmatch(f"[{p}]", chr(c))) for c in (0, *range(32, 127), 1)]) for p in (KEY_CHARACTERS, "0-9", "A-Za-z"))
#: Texts of a group lie so far apart that no candidate reads another text.
_APART = char_cnn.BEFORE + char_cnn.HALO
#: What a unit returns: rows of networks and rows of labelled candidates.
FIT = "half int, network array<float>, weight long, open long, label int, inside int, snippet binary, drawn binary"


#: Labels of candidates.
OPEN, POSITIVE, NEGATIVE = 0, 1, 2


def runs(x: np.ndarray, base: list, others: list = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, labels) of the candidates of a text's classes: POSITIVE where a base finding ends; NEGATIVE where none overlaps, but one of ``others`` does or no letter stands; else OPEN where none overlaps."""
    key = np.zeros(len(x) + 2, np.int8)
    key[1:-1] = _KEY[x]
    edge = np.diff(key)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= LEAST_CHARS
    starts, ends = starts[long], ends[long]
    letters = np.concatenate([[0], np.cumsum(_LETTER[x])])
    refused = (letters[ends] == letters[starts]) | _met(starts, ends, others, len(x))[0]
    met, ended = _met(starts, ends, base, len(x))
    kept = ~met | ended
    return starts[kept], ends[kept], np.where(met, POSITIVE, np.where(refused, NEGATIVE, OPEN))[kept]


def _met(starts: np.ndarray, ends: np.ndarray, spans: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether any of the spans overlaps, whether any ends within) each candidate of a text of ``n`` characters."""
    if not spans:
        return np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    covered, closes = np.zeros(n + 1, np.int64), np.zeros(n + 2, np.int64)
    for _, a, b in spans:
        covered[a + 1 : b + 1] = 1
        closes[b + 1] = 1
    covered, closes = np.cumsum(covered), np.cumsum(closes)
    return covered[ends] > covered[starts], closes[ends + 1] > closes[starts + 1]


def half(text: str) -> int:
    """The half that a text and its copies are of."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) & 1


def joined(texts: list[str], bases: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(classes, starts, ends, labels, each text's offset) of the candidates of texts that are read as one, apart from each other."""
    gap = np.zeros(_APART, np.uint8)
    parts, found, offsets, at = [gap[:0]], [(np.empty(0, np.int64),) * 3], [], 0
    for text, base in zip(texts, bases):
        x = char_cnn.classes(text)
        s, e, label = runs(x, base, personal(text))
        found.append((s + at, e + at, label))
        offsets.append(at)
        parts += [x, gap]
        at += len(x) + _APART
    return np.concatenate(parts), *map(np.concatenate, zip(*found)), offsets


def _hinge(y: np.ndarray, weight: np.ndarray):
    """Slope of the weighted squared hinge loss, which is linear from a distance of 2 on; 0 beyond the margin."""
    return lambda z: -y * weight * np.clip(1 - y * z, 0, 2)


def fit_unit(p: dict, other: dict | None, x: np.ndarray, starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, seed: int) -> tuple[dict, int]:
    """Fit a network further on all candidates of a unit's texts; (network, open candidates read in one pass).

    Each step scores the next open candidates and fits those whose loss is not 0, besides some
    positives and labelled negatives. A pass ends when all of each have had their turn; small units are
    passed again. What the ``other`` half's network calls a secret is no negative.
    """
    rng = np.random.default_rng(seed)
    kinds = [rng.permutation(np.flatnonzero(labels == k)) for k in (POSITIVE, NEGATIVE)]
    # Open candidates come as they stand, so that the convolution runs once over the text.
    open_ = np.flatnonzero(labels == OPEN)
    adam, many, done = char_cnn.Adam(p, rng), LABELLED, 0
    while adam.steps < STEPS:
        before, at = adam.steps, 0
        while at < len(open_) or any((adam.steps - before) * LABELLED < len(k) for k in kinds):
            part = open_[at : at + many]
            at += len(part)
            if len(part):
                part = part[char_cnn.scores(adam.p, x, starts[part], ends[part]) > -1]
            if len(part) and other is not None:
                part = part[char_cnn.logits(other, *char_cnn.windows(x, starts[part], ends[part])) <= 0]
            if len(part) > 2 * LABELLED:
                many = max(LABELLED, many // 2)
            elif len(part) < LABELLED:
                many = min(MOST, 2 * many)
            turn = (adam.steps - before) * LABELLED + np.arange(LABELLED)
            rows = [k[turn % len(k)] if len(k) else k for k in kinds] + [part]
            share = (0.5, 0.2, 0.3 * min(1, len(part) / LABELLED))
            y = np.repeat([1.0, -1.0, -1.0], [len(r) for r in rows])
            weight = np.repeat(share, [len(r) for r in rows]) / np.repeat([max(len(r), 1) for r in rows], [len(r) for r in rows])
            rows = np.concatenate(rows)
            if not len(rows):
                adam.steps += 1  # nothing of these has a loss
                continue
            adam.step(*char_cnn.windows(x, starts[rows], ends[rows]), _hinge(y, weight))
        if adam.steps == before:
            break
    return adam.p, len(open_)


def _fitted(shared, careful: bool):
    """The networks of both halves, fitted further on a unit, and its labelled candidates."""
    schema = arrow_schema(FIT)

    def unit(key, table):
        seed = int(key[0].as_py())
        texts = sorted(t or "" for t in table.column("text").to_pylist())
        order = np.random.default_rng(seed).permutation(len(texts))
        networks, out = [char_cnn.shaped(v) for v in shared.value], []
        for side in (0, 1):
            mine = [texts[i] for i in order if half(texts[i]) == side]
            x, starts, ends, labels, _ = joined(mine, [secrets(t) for t in mine])
            network, n_open = fit_unit(networks[side], networks[1 - side] if careful else None, x, starts, ends, labels, seed)
            row = {"half": side, "network": char_cnn.flat(network).tolist(), "weight": 1 + int((labels == POSITIVE).sum()), "open": n_open}
            out.append(pa.Table.from_pylist([row], schema=schema))
            known, rng = np.flatnonzero(labels != OPEN), np.random.default_rng(seed)
            for i in range(0, len(known), 4096):
                part = known[i : i + 4096]
                snippets, inside = char_cnn.windows(x, starts[part], ends[part])
                columns = {"half": [side] * len(part), "label": labels[part], "inside": inside, "snippet": list(map(bytes, snippets)), "drawn": list(map(bytes, char_cnn.redrawn(snippets, rng)))}
                out.append(pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(part), f.type) for f in schema], schema=schema))
        return pa.concat_tables(out)

    return unit


def train(rows: DataFrame, recall: float = RECALL) -> list[dict] | None:
    """The model that scans each half, from all candidates of (doc, text); None if a half has less than 5 positives."""
    with temporary(rows.sparkSession):
        return _train(rows, recall)


def _train(rows: DataFrame, recall: float) -> list[dict] | None:
    spark = rows.sparkSession
    chars = rows.agg(F.sum(F.length("text"))).first()[0]
    if not chars:
        return None
    # The units depend on the table alone, not on how it is stored. Copies of a text with other ids are dealt out.
    slices = min(ROUNDS, -(-chars // UNIT_CHARS))
    shards = -(-chars // (slices * UNIT_CHARS))
    units = rows.select("text", F.pmod(F.xxhash64("text", "doc"), F.lit(slices * shards)).alias("unit"))
    networks, labelled, read = [char_cnn.flat(char_cnn.started())] * 2, [], [0, 0]
    for r in range(ROUNDS):
        mine = units.where(F.col("unit").between(r % slices * shards, r % slices * shards + shards - 1))
        done = materialize(mine.groupBy("unit").applyInArrow(_fitted(spark.sparkContext.broadcast(networks), r > 0), FIT))
        each = done.where("network IS NOT NULL").select("half", "weight", F.posexplode("network").alias("at", "value"))
        # Sums of whole numbers don't depend on their order.
        mean = F.sum(F.round(F.col("value").cast("double") * SCALE).cast("long") * F.col("weight")) / F.sum("weight") / SCALE
        got = {(k["half"], k["at"]): k["mean"] for k in each.groupBy("half", "at").agg(mean.alias("mean")).collect()}  # a row for each parameter
        networks = [np.array([got.get((side, i), v) for i, v in enumerate(old)], np.float32) for side, old in enumerate(networks)]
        if r < slices:
            labelled.append(done.where("label IS NOT NULL"))
            for k in done.groupBy("half").agg(F.sum("open").alias("n")).collect():
                read[k["half"]] += k["n"]
        if r == slices - 1:
            known = reduce(DataFrame.unionAll, labelled)
            found = {k["half"]: k["count"] for k in known.where(F.col("label") == POSITIVE).groupBy("half").count().collect()}
            if min(found.get(side, 0) for side in (0, 1)) < 5:
                return None
    judged = materialize(known.select("half", "label", "inside", "snippet", "drawn").mapInArrow(_judged(spark.sparkContext.broadcast(networks)), "half int, label int, z double"))
    models = []
    for side in (0, 1):
        z = judged.where(F.col("half") == side)  # of the network that has not read them
        a, b = platt(z)
        true = F.col("label") == POSITIVE
        least = nth_largest(z.where(true).select("z"), int(np.ceil(recall * 2 * found[side])))
        above = F.col("z") >= least
        n = z.agg(F.count_if(true).alias("findings"), F.count_if(true & above).alias("recalled"), F.count_if(~true).alias("negatives"), F.count_if(~true & above).alias("false")).first()
        p = 1 / (1 + np.exp(-np.clip(a * least + b, -30, 30)))
        # Each labelled candidate is judged twice, with its letters before and with others.
        counts = {"findings": n["findings"] // 2, "negatives": n["negatives"] // 2, "open": read[side]}
        models.append({"network": char_cnn.shaped(networks[1 - side]), "a": a, "b": b, "threshold": float(p), "recall": n["recalled"] / n["findings"], "false": n["false"] / max(n["negatives"], 1)} | counts)
    return models


def _judged(shared):
    """The scores of labelled candidates, as they are and redrawn, by the network of the other half."""

    def run(batches):
        networks = [char_cnn.shaped(v) for v in shared.value]
        for batch in batches:
            side, label, inside = (np.array(batch.column(i)) for i in range(3))
            for column in (3, 4):
                x = char_cnn.stacked(batch.column(column).to_pylist())
                for k in (0, 1):
                    mine = side == k
                    z = char_cnn.logits(networks[1 - k], x[mine], inside[mine])
                    yield pa.RecordBatch.from_arrays([pa.array(side[mine], pa.int32()), pa.array(label[mine], pa.int32()), pa.array(z, pa.float64())], ["half", "label", "z"])

    return run


def nth_largest(z: DataFrame, n: int) -> float:
    """The ``n``-th largest z, counted from 1, by counts of 1024 ranges at a time; no task or driver holds the values."""
    lo, hi = z.agg(F.min("z"), F.max("z")).first()
    while lo < hi:
        part = F.least(F.floor((F.col("z") - lo) / (hi - lo) * 1024), F.lit(1023)).alias("part")
        for k in sorted(z.where(F.col("z").between(lo, hi)).groupBy(part).agg(F.count("*").alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")).collect(), reverse=True):
            if n <= k["n"]:
                lo, hi = k["lo"], k["hi"]
                break
            n -= k["n"]
    return float(lo)


def platt(z: DataFrame) -> tuple[float, float]:
    """Platt scaling of (label, z): (a, b) of 1 / (1 + exp(-(a z + b))) on smoothed labels; (1, 0) where scores don't rise with labels or a label is missing."""
    true = F.col("label") == POSITIVE
    n1, n0 = z.agg(F.count_if(true), F.count_if(~true)).first()
    if not n1 or not n0:
        return 1.0, 0.0
    target = F.when(true, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w"))))
    rows = VectorAssembler(inputCols=["z"], outputCol="x").transform(z.select("z", both.alias("of")).select("z", "of.y", "of.w"))
    found = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w").fit(rows)
    a, b = float(found.coefficients[0]), float(found.intercept)
    return (a, b) if a > 0 else (1.0, 0.0)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """(doc, n_assign, n_access, n_hex, base, added) for each row of ``docs``.

    ``base`` lists the spans (kind, start, end) of the base rules by start, then kind; ``added``
    those of the networks, of kind "learned", which overlap none of base. Counts are of base spans.
    Positions are code points, ends exclusive. Without enough findings in both halves of the texts the
    networks add nothing. Null and empty texts have no spans; null or repeated ids give a row each; ids
    keep their type. Other columns are ignored; an empty table gives an empty table. ``docs`` is read
    once for its size, once in each round of the fit and once by the scan. Rows equal in both id and
    text are fitted by one task.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in SECRET)
    shared = docs.sparkSession.sparkContext.broadcast(train(rows, recall))
    return map_text_groups(rows, "doc", "text", f"doc {kind}, {counts}, base array<{SPAN}>, added array<{SPAN}>", _scored(shared))


def _scored(shared):
    def make():
        models = shared.value

        def group(rows):
            texts = [text for _, text in rows]
            bases, added = [secrets(text) for text in texts], [[] for _ in rows]
            sides = [half(text) for text in texts] if models else []
            for side, model in enumerate(models or ()):
                mine = [i for i, k in enumerate(sides) if k == side]
                for i, found in zip(mine, secret_runs(model, [texts[i] for i in mine], [bases[i] for i in mine])):
                    added[i] = found
            for (doc, _), base, found in zip(rows, bases, added):
                learned = [{"kind": LEARNED, "start": a, "end": b} for a, b in found]
                yield (doc, *(sum(k == kind for k, _, _ in base) for kind in SECRET), [{"kind": k, "start": a, "end": b} for k, a, b in base], learned)

        return group

    return make


def secret_runs(model: dict, texts: list[str], bases: list) -> list[list[tuple[int, int]]]:
    """For each text, those of its open candidates that the network gives the threshold's probability or more.

    The texts are read as one, apart from each other.
    """
    x, s, e, label, offsets = joined(texts, bases)
    s, e = s[label == OPEN], e[label == OPEN]
    z = char_cnn.scores(model["network"], x, s, e)
    kept = np.flatnonzero(1 / (1 + np.exp(-np.clip(model["a"] * z + model["b"], -30, 30))) >= model["threshold"])
    found: list[list] = [[] for _ in texts]
    for i, owner in zip(kept.tolist(), (np.searchsorted(offsets, s[kept], "right") - 1).tolist()):
        found[owner].append((int(s[i]) - offsets[owner], int(e[i]) - offsets[owner]))
    return found


def spans_by_start(base: str, added: str) -> F.Column:
    """Both arrays in one, by start, then kind as listed."""
    order = F.array(*map(F.lit, KINDS))
    both = F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(both), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
