"""Personal data: bootstrapped contextual extraction.

Base rules find e-mail and IP addresses, card and phone numbers. These are seeds: the words around
them are lexical patterns (two words before, the word before, the word after, the words on either
side), and Spark scores the graph of patterns and instances in rounds. A pattern of a kind is as good
as the share of its distinct instances that are known to be of that kind; an instance is as good as
its patterns together make it. Any token in the place of a seed is an instance, so patterns with high
confidence discover identifiers of unseen forms. Tokens of letters alone are words: they count
against a pattern but are never added.

What is discovered is known from then on: a round looks its instances up in all texts, and their other
occurrences induce patterns as seeds do, which discover more. Rounds end when one discovers nothing.

A pattern takes part once SUPPORT distinct known instances stand in it, and once the known ones are
SEED_SHARE of all, counted by document. Frequent words have that many but not that share; a pattern
that the documents of one hash in SIFT already refute (counts only grow) is not counted over the rest,
which changes no result. Both tests are repeated as more instances are known. Patterns travel as
64-bit hashes; what tells tasks of patterns and instances of interest is a bitmap of fixed size that
may let others through, which joins then sort out, so the size costs time at most.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, map_text_groups, materialize
from .spans import PERSONAL, overlaps, personal
from .superminhash import mixed

ROUNDS = 3
#: A pattern counts from this confidence, with so many distinct known instances at least.
CONFIDENCE = 0.8
SUPPORT = 4
#: A pattern takes part if known instances are this share of its instances, counted by document.
SEED_SHARE = 0.2
#: Documents of one hash in so many sift patterns before the others count them.
SIFT = 16
#: Words whose hashes a task keeps between texts.
KNOWN_WORDS = 200_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANKS = " \t\n\x0b\x0c\r"
_EDGE = "\"'()[]{}<>,;:!?."
_EDGE_BYTES = _EDGE.encode()

SPAN = "struct<kind:string,start:int,end:int>"
SEED = "struct<kind:string,instance:string,patterns:array<long>>"
OCCURRENCE = "struct<start:int,end:int,instance:string,plain:boolean,pattern:long>"


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word.lower()) | 1


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _patterns(two: np.ndarray, one: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hashes (rows, 4) of the patterns of places whose words before and after have these hashes; 0 where a word is missing."""
    shape = lambda n, *parts: mixed(np.uint64(n) + sum((mixed(x + np.uint64(7 * i)) for i, x in enumerate(parts)), np.uint64(0)))
    none = np.uint64(0)
    with np.errstate(over="ignore"):
        rows = (
            np.where((two > 0) & (one > 0), shape(1, two, one), none), np.where(one > 0, shape(2, one), none),
            np.where(after > 0, shape(3, after), none), np.where((one > 0) & (after > 0), shape(4, one, after), none),
        )
    return np.stack(rows, 1)


class Words:
    """Hashes of words (of bytes, A-Z lower-cased), whole and of the core without punctuation at its ends, how much that is, and whether the core is of letters alone.

    Row 0 is no word.
    """

    def __init__(self):
        self.index, self.table = {}, np.zeros((1 << 14, 5), np.uint64)

    def forget(self) -> None:
        """Start anew once there are many; numbers that were given hold no longer."""
        if len(self.index) > KNOWN_WORDS:
            self.index = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The number of each word's row."""
        index = self.index
        new = list(set(words).difference(index))
        rows = []
        for w in new:
            core = w.strip(_EDGE_BYTES)
            lead = len(w) - len(w.lstrip(_EDGE_BYTES)) if core else len(w)
            rows.append((_hash(w), _hash(core) if core else 0, lead, len(w) - lead - len(core), core.decode("utf-8", "surrogatepass").isalpha()))
        first = len(index) + 1
        index.update(zip(new, range(first, first + len(new))))
        while len(self.table) < first + len(new):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if rows:
            self.table[first : first + len(new)] = np.array(rows, np.uint64)
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))


def _around(table: np.ndarray, ids: np.ndarray) -> tuple:
    """Hashes of the two words before, the one before and the one after each word of a sequence."""
    whole, none = table[ids, 0], np.zeros(2, np.uint64)
    return np.concatenate([none, whole[:-2]])[: len(whole)], np.concatenate([none[:1], whole[:-1]])[: len(whole)], np.concatenate([whole[1:], none[:1]])[: len(whole)]


def places(text: str, base: list, words: Words) -> tuple:
    """(starts, ends, cores, plain, patterns) of the tokens of a text that overlap nothing of ``base``."""
    raw = _bytes(text)
    spans = [m.span() for m in _WORD.finditer(raw)]
    ids = words([raw[a:b] for a, b in spans])
    table = words.table[ids]
    # From bytes to code points: those that continue a character are left out.
    at = np.array(spans, np.int64).reshape(-1, 2)
    point = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    start, end = point[at[:, 0] + table[:, 2].astype(np.int64)], point[at[:, 1] - table[:, 3].astype(np.int64)]
    kept = table[:, 1] > 0
    if base:
        taken = overlaps(base)
        kept &= ~np.fromiter((taken(a, b) for a, b in zip(start.tolist(), end.tolist())), bool, len(start))
    return start[kept], end[kept], table[kept, 1], table[kept, 4] > 0, _patterns(*_around(words.table, ids))[kept]


def plain_hits(texts: list[str], words: Words, bits: np.ndarray) -> tuple:
    """(text, pattern, core) of the tokens of texts without base spans that the bitmap tells of, all texts at once."""
    parts = [words(_bytes(t).split()) for t in texts]  # of bytes: at the space and the code points 9 to 13
    gap = np.zeros(2, np.int64)
    ids = np.concatenate([x for p in parts for x in (p, gap)] or [gap])
    owner = np.repeat(np.arange(len(texts)), [len(p) + 2 for p in parts])
    two, one, after = _around(words.table, ids)
    core = words.table[ids, 1]
    at = np.flatnonzero(core > 0)
    row, shape = np.nonzero(_inside(bits, patterns := _patterns(two[at], one[at], after[at])))
    return owner[at[row]], patterns[row, shape], core[at[row]]


def seed_patterns(text: str, base: list) -> np.ndarray:
    """Hashes (rows, 4) of the patterns around each base span; the rest of a span's own token is a word, unless it is punctuation."""
    found = []
    for _, a, b in base:
        left, right = a, b
        while left > 0 and text[left - 1] not in _BLANKS:
            left -= 1
        while right < len(text) and text[right] not in _BLANKS:
            right += 1
        before = _last_words(text, left, 2)
        words = [_hash(_bytes(w)) for w in before] + ([_hash(_bytes(text[left:a]))] if text[left:a].strip(_EDGE) else [])
        words = [0, 0, *words][-2:]
        if text[b:right].strip(_EDGE):
            after = _hash(_bytes(text[b:right]))
        else:
            start = right
            while start < len(text) and text[start] in _BLANKS:
                start += 1
            stop = start
            while stop < len(text) and text[stop] not in _BLANKS:
                stop += 1
            after = _hash(_bytes(text[start:stop])) if stop > start else 0
        found.append((*words, after))
    return _patterns(*np.array(found, np.uint64).reshape(-1, 3).T)


def _last_words(text: str, end: int, n: int) -> list[str]:
    """The ``n`` words before a place, fewer if there are fewer."""
    found = []
    while len(found) < n:
        while end > 0 and text[end - 1] in _BLANKS:
            end -= 1
        at = end
        while at > 0 and text[at - 1] not in _BLANKS:
            at -= 1
        if at == end:
            break
        found.append(text[at:end])
        end = at
    return found[::-1]


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def _parsed():
    def group(rows):
        for doc, text in rows:
            base = personal(text)
            spans = [{"kind": k, "start": a, "end": b} for k, a, b in base]
            seeds = [{"kind": k, "instance": text[a:b].lower(), "patterns": [p for p in _signed(ps) if p]} for (k, a, b), ps in zip(base, seed_patterns(text, base))]
            yield (doc, *(sum(k == kind for k, _, _ in base) for kind in PERSONAL), spans, seeds, xxhash.xxh3_64_intdigest(_bytes(text)) - (1 << 63))

    return group


def _inside(bits: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    return in_bitmap(bits, patterns) & (patterns > 0)


def _counted(shared):
    """(pattern, n): for the patterns of the bitmap, distinct instances of each document that are no seeds, summed over a group of texts."""

    def make():
        bits, words = np.frombuffer(shared.value, np.uint8), Words()

        def group(rows):
            words.forget()
            bases = [personal(text) for _, text in rows]
            doc, pattern, core = plain_hits([text for (_, text), base in zip(rows, bases) if not base], words, bits)
            found = [np.stack([doc.astype(np.uint64), pattern, core], 1)]
            for i, ((_, text), base) in enumerate(zip(rows, bases)):
                if base:
                    _, _, core, _, patterns = places(text, base, words)
                    row, shape = np.nonzero(_inside(bits, patterns))
                    found.append(np.stack([np.full(len(row), len(rows) + i, np.uint64), patterns[row, shape], core[row]], 1))
            keys = np.concatenate(found)
            if len(keys):
                keys = keys[np.lexsort(keys.T)]
                fresh = np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])
                pattern, n = np.unique(keys[fresh, 1], return_counts=True)
                yield from zip(_signed(pattern), n.tolist())

        return group

    return make


def _occurrences(shared):
    def make():
        bits, words = np.frombuffer(shared.value, np.uint8), Words()

        def group(rows):
            words.forget()
            bases = [personal(text) for _, text in rows]
            free = [i for i, base in enumerate(bases) if not base]
            doc, _, _ = plain_hits([rows[i][1] for i in free], words, bits)
            for i in sorted({free[d] for d in set(doc.tolist())} | {i for i, base in enumerate(bases) if base}):
                text = rows[i][1]
                start, end, _, plain, patterns = places(text, bases[i], words)
                row, shape = np.nonzero(_inside(bits, patterns))
                if len(row):
                    near = [
                        {"start": a, "end": b, "instance": text[a:b].lower(), "plain": bool(w), "pattern": p}
                        for a, b, w, p in zip(start[row].tolist(), end[row].tolist(), plain[row], _signed(patterns[row, shape]))
                    ]
                    yield rows[i][0], xxhash.xxh3_64_intdigest(_bytes(text)) - (1 << 63), near

        return group

    return make


def pattern_confidence(edges: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """(pattern, kind, confidence, mass) of the trusted patterns, from edges (pattern, instance, kind or null).

    Joins go by pattern and by instance in turn; a pattern of very many instances is summed where its
    edges lie before they meet, and Spark splits skewed join partitions.
    """
    edges = materialize(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    seeds = edges.where("kind is not null").groupBy("instance", "kind").agg(F.lit(1.0).alias("score"))
    totals = materialize(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support))
    known, trusted = materialize(seeds), None
    for i in range(rounds):
        mass = edges.select("pattern", "instance").join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        scored = mass.join(totals, "pattern").withColumn("confidence", F.col("mass") / F.col("n"))
        trusted = materialize(scored.where((F.col("mass") >= support) & (F.col("confidence") >= confidence)).select("pattern", "kind", "confidence", "mass"))
        if i + 1 == rounds:
            break
        doubt = F.sum(F.ln(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
        reached = edges.where("kind is null").select("pattern", "instance").join(trusted, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        known = materialize(reached.unionByName(seeds).groupBy("instance", "kind").agg(F.max("score").alias("score")))
    return trusted


def _sighted(shared):
    """(text_key, instance, patterns) of the tokens, outside base spans, that the bitmap of instances lets through."""

    def make():
        bits, words = np.frombuffer(shared.value, np.uint8), Words()

        def group(rows):
            words.forget()
            for doc, text in rows:
                ids = words(_bytes(text).split())
                if not in_bitmap(bits, words.table[ids, 1]).any():
                    continue
                start, end, core, _, patterns = places(text, personal(text), words)
                key = xxhash.xxh3_64_intdigest(_bytes(text)) - (1 << 63)
                for i in np.flatnonzero(in_bitmap(bits, core)).tolist():
                    yield doc, key, text[start[i] : end[i]].lower(), [p for p in _signed(patterns[i]) if p]

        return group

    return make


def _instance_hashes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.array([_hash(_bytes(w)) for w in batch.column(0).to_pylist()], np.uint64).view(np.int64))], names=["hash"])


def known_counts(known: DataFrame) -> DataFrame:
    """(pattern, instances, n_known, n_seed): distinct known instances, and those of each document summed, of all and of base seeds."""
    within = known.groupBy("pattern", "instance", "doc", "text_key").agg(F.max("seed").alias("seed"))
    each = within.groupBy("pattern", "instance").agg(F.count("*").alias("docs"), F.sum("seed").alias("seeds"))
    return each.groupBy("pattern").agg(F.count("*").alias("instances"), F.sum("docs").alias("n_known"), F.sum("seeds").alias("n_seed"))


def _active(rows: DataFrame, candidates: DataFrame, share: float) -> DataFrame:
    """(pattern) of those whose known instances are ``share`` of all, counted by document.

    ``rows`` is (doc, text), ``candidates`` (pattern, instances, n_known, n_seed). What is counted are
    tokens outside base spans, known ones included.
    """
    context = rows.sparkSession.sparkContext

    def counted(part: DataFrame, patterns: DataFrame) -> DataFrame:
        bits = context.broadcast(bitmap(patterns.select(F.col("pattern").alias("hash"))))
        found = map_text_groups(part, "doc", "text", "pattern long, n long", _counted(bits), chars=1 << 20)
        n = F.coalesce("n_token", F.lit(0))
        met = patterns.join(found.groupBy("pattern").agg(F.sum("n").alias("n_token")), "pattern", "left")
        return met.where(F.col("n_known") >= share * (F.col("n_seed") + n)).drop("n_token")

    sieve = rows.where(F.pmod(F.xxhash64("text"), F.lit(SIFT)) == 0)
    return materialize(counted(rows, materialize(counted(sieve, candidates))).select("pattern"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT, seed_share: float = SEED_SHARE) -> DataFrame:
    """(doc, n_email, n_ip, n_card, n_phone, base, added) for each row of ``docs``.

    ``base`` lists the spans (kind, start, end) of the base rules by kind, then start; ``added``
    those that patterns discovered, which overlap none of base, in the same order. Counts are of
    base spans. Positions are code points, ends exclusive. Null and empty texts have no spans; texts
    of any length are read whole; null or repeated ids give a row each; ids keep their type. Other
    columns are ignored, whatever their names; an empty table gives an empty table. ``rounds`` bounds
    how often discoveries teach patterns, and the rounds of a scoring.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind_of_id = rows.schema["doc"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in PERSONAL)
    parsed = materialize(map_text_groups(rows, "doc", "text", f"doc {kind_of_id}, {counts}, base array<{SPAN}>, seeds array<{SEED}>, text_key long", _parsed))
    seeds = parsed.where("size(seeds) > 0").select("doc", "text_key", F.inline("seeds"))
    known = materialize(seeds.select("doc", "text_key", "kind", "instance", F.lit(1).alias("seed"), F.explode("patterns").alias("pattern")))
    labelled = known.select("pattern", "instance", "kind").distinct()
    active = seen = trusted = looked_up = None
    for i in range(rounds):
        candidates = known_counts(known).where(F.col("instances") >= support)
        candidates = materialize(candidates if active is None else candidates.join(active, "pattern", "left_anti"))
        fresh = candidates.select("pattern") if candidates.isEmpty() else _active(rows, candidates, seed_share)
        if i and fresh.isEmpty():
            break
        near = map_text_groups(rows, "doc", "text", f"doc {kind_of_id}, text_key long, near array<{OCCURRENCE}>", _occurrences(context.broadcast(bitmap(fresh.withColumnRenamed("pattern", "hash")))), chars=1 << 18)
        found = materialize(near.select("doc", "text_key", F.inline("near")).join(fresh, "pattern"))
        active, seen = (fresh, found) if active is None else (materialize(active.unionByName(fresh)), seen.unionByName(found))
        edges = seen.select("pattern", "instance", F.lit(None).cast("string").alias("kind")).unionByName(labelled.join(active, "pattern").select("pattern", "instance", "kind"))
        trusted = pattern_confidence(edges, rounds, confidence, support)
        reached = seen.where("not plain").join(trusted, "pattern").groupBy("instance").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
        reached = materialize(reached if looked_up is None else reached.join(looked_up, "instance", "left_anti"))
        if i + 1 == rounds or reached.isEmpty():
            break
        looked_up = reached.select("instance") if looked_up is None else materialize(looked_up.unionByName(reached.select("instance")))
        bits = context.broadcast(bitmap(reached.select("instance").mapInArrow(_instance_hashes, "hash long")))
        sighted = map_text_groups(rows, "doc", "text", f"doc {kind_of_id}, text_key long, instance string, patterns array<long>", _sighted(bits)).join(reached, "instance")
        more = sighted.select("doc", "text_key", "kind", "instance", F.lit(0).alias("seed"), F.explode("patterns").alias("pattern"))
        known = materialize(known.unionByName(more))
    kinds = F.array(*map(F.lit, PERSONAL))
    hits = seen.where("not plain").join(trusted, "pattern").groupBy("doc", "text_key", "start", "end").agg(F.max_by("kind", F.struct("confidence", F.negative(F.array_position(kinds, F.col("kind"))))).alias("kind"))
    place = F.array_position(kinds, F.col("kind"))
    # Repeated rows have their occurrences once here, and each takes them.
    added = hits.groupBy("doc", "text_key").agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind"))).alias("added"))
    added = added.select(F.col("doc").alias("__doc"), F.col("text_key").alias("__key"), F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("added"))
    joined = parsed.join(added, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key")), "left")
    return joined.select("doc", *(f"n_{k}" for k in PERSONAL), "base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")).alias("added"))


def span_digest(column: str) -> F.Column:
    return F.sha2(span_text(F.col(column)), 256)


def span_text(spans: F.Column) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def all_spans(base: str, added: str, kinds: tuple = PERSONAL) -> F.Column:
    """Both arrays in one, by kind as listed, then start."""
    order = F.array(*map(F.lit, kinds))
    both = F.transform(F.concat(base, added), lambda s: F.struct(F.array_position(order, s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(both), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
