"""Phrase collocations: words that stand together more often than their parts would by chance.

Texts are cut into pieces and words, and laid on a line of positions, with an empty position between
pieces; a shard is a stretch of it. In a shard each word has a compressed bitmap of its positions (the
64-bit blocks that hold a bit). A phrase's bitmap is where it ends; shifted by one and ANDed with a
word's it gives the longer phrase, which no piece boundary lets through, and the count of its bits are
its occurrences (a phrase found a few times in a shard goes on from each place). Phrases are extended depth first, a shard at a time, and the counts of all shards are
summed by Spark.

A phrase is frequent only if its parts are. So four readings: the first counts words; the second pairs
of frequent words, all words' shifted bitmaps being met at once, as a bit stands on one word at most;
the third triples of frequent pairs in the same way; the fourth goes depth first through frequent
triples. What tells a task of frequent words, pairs and triples is a bitmap of hashes of fixed size,
which may let others through; they cost time only, as the sums are by the phrases themselves.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.shared import temporary

from .common import BITMAP_BITS, bitmap, in_bitmap, materialize
from .superminhash import mixed

#: Positions of a shard, but for a longer piece. Words are counted over longer stretches, which need no bitmaps.
SHARD = 1 << 19
COUNTED = 1 << 22
LEAST, LONGEST, BEST = 100, 5, 2000
UNKNOWN = "und"

#: A-Z to a-z, and what ends a piece (.,;:!? and the code points 10 to 13) to a line feed.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + b"\n" * len(_ENDS))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 32]] = True
#: Characters that are parsed at once, words of a task's vocabulary between shards, pairs or triples and longer phrases that a task sums, rows given out at once.
GROUP = 1 << 20
KNOWN_WORDS = 300_000
HELD_KEYS = 1 << 22
HELD_PHRASES = 1 << 18
BATCH = 1 << 16
#: Up to so many places are followed one by one; a bitmap of them saves nothing.
FEW = 32


class Vocabulary(dict):
    """Numbers from 1 for words, in order of their first use; 0 for those that ``bits``, a bitmap of hashes, does not let through."""

    def __init__(self, lang: str, bits: bytes | None):
        super().__init__()
        self.seed, self.bits, self.words, self.hashes = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=42), bits, [b""], [0]

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, seed=self.seed)
        at = h & (BITMAP_BITS - 1)
        if self.bits is not None and not self.bits[at >> 3] >> (at & 7) & 1:
            self[word] = 0
            return 0
        self[word] = n = len(self.words)
        self.words.append(word)
        self.hashes.append(h)
        return n


def line_of_words(texts: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """The words' numbers at their positions, 0 between pieces and at the end."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_TABLE)
    words = raw.split()
    if not words:
        return np.zeros(1, np.int32)
    codes = np.frombuffer(raw, np.uint8)
    inside = ~_BLANK[codes]
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    cut = np.zeros(len(words) + 1, np.int64)
    cut[np.searchsorted(starts, np.flatnonzero(codes == 10))] = 1
    cut[0] = 0
    place = np.arange(len(words)) + np.cumsum(cut[:-1])
    line = np.zeros(int(place[-1]) + 2, np.int32)
    line[place] = np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words))
    return line


class _Stretch:
    """What was read of a language and not yet given out."""

    def __init__(self, lang: str, bits: bytes | None):
        self.lang, self.vocabulary, self.texts, self.chars, self.lines, self.n = lang, Vocabulary(lang, bits), [], 0, [], 0

    def add(self, text: str) -> None:
        self.texts.append(text)
        self.chars += len(text) + 1

    def parse(self) -> None:
        if self.texts:
            self.lines.append(line_of_words(self.texts, self.vocabulary))
            self.n += len(self.lines[-1])
            self.texts, self.chars = [], 0

    def cut(self, size: int):
        """All of it in stretches of ``size`` to twice that, cut where no word stands."""
        line = np.concatenate(self.lines)
        free, start = np.flatnonzero(line == 0), 0
        while len(line) - start > 2 * size:
            at = int(free[np.searchsorted(free, start + size)]) + 1  # a line ends with an empty place
            yield self.lang, self.vocabulary, line[start:at]
            start = at
        if start < len(line):
            yield self.lang, self.vocabulary, line[start:]
        self.lines, self.n = [], 0


def shards(batches, size: int, bits: bytes | None = None):
    """(lang, vocabulary, line) of stretches of ``size`` positions or more, of batches (lang, text)."""
    held: dict[str, _Stretch] = {}
    for batch in batches:
        texts = batch.column(1)
        for i, lang in enumerate(batch.column(0).to_pylist()):
            part = held.get(lang)
            if part is None:
                part = held[lang] = _Stretch(lang, bits)
            part.add(texts[i].as_py() or "")
            if part.chars >= GROUP:
                part.parse()
                if part.n >= size:
                    yield from part.cut(size)
                    if len(part.vocabulary) > KNOWN_WORDS:
                        del held[lang]
    for part in held.values():
        part.parse()
        if part.n:
            yield from part.cut(size)


def _counts(rows, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(rows, names=names)


def _word_counts(batches):
    for lang, vocabulary, line in shards(batches, COUNTED):
        n = np.bincount(line, minlength=1)
        found = np.flatnonzero(n)
        found = found[found > 0]
        for i in range(0, len(found), BATCH):
            part = found[i : i + BATCH]
            yield _counts([pa.array([lang] * len(part), pa.string()), pa.array([vocabulary.words[k].decode("utf-8", "surrogatepass") for k in part.tolist()], pa.string()), pa.array(n[part], pa.int64())], ["lang", "phrase", "n"])


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs from those of their parts."""
    with np.errstate(over="ignore"):
        return mixed(first + mixed(second))


def key_hash(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Hashes of two words, or of three where the third is not 0."""
    pair = pair_hash(first, second)
    return np.where(third > 0, pair_hash(pair, third), pair)


def may_be_frequent(line: np.ndarray, hashes: np.ndarray, bits: np.ndarray | None, width: int, within: np.ndarray | None = None) -> np.ndarray:
    """At which places ``width`` words begin that the bitmap lets through, all of them if there is none; ``within`` tells so of one word less."""
    may = np.zeros(len(line), bool)
    if width == 2:
        at = np.flatnonzero((line[:-1] > 0) & (line[1:] > 0))
        found = pair_hash(hashes[line[at]], hashes[line[at + 1]]) if bits is not None else None
    else:
        at = np.flatnonzero(within[:-1] & within[1:])
        found = pair_hash(pair_hash(hashes[line[at]], hashes[line[at + 1]]), hashes[line[at + 2]]) if bits is not None else None
    may[at] = True if found is None else in_bitmap(bits, found)
    return may


def _short_counts(words, pairs):
    """(first, second, third, n) of the words' hashes: pairs of frequent words (third is 0) or, given the bitmap of pairs, triples of frequent pairs.

    Counts are summed over a task's shards while they fit.
    """

    def merged(held):
        first, second, third, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(key_hash(first, second, third), kind="stable")
        first, second, third, n = (x[order] for x in (first, second, third, n))
        fresh = np.ones(len(n), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (third[1:] != third[:-1])
        at = np.flatnonzero(fresh)
        return first[at], second[at], third[at], np.add.reduceat(n, at)

    def given(held):
        *keys, n = merged(held)
        for i in range(0, len(n), BATCH):
            yield _counts([*(pa.array(k[i : i + BATCH].view(np.int64)) for k in keys), pa.array(n[i : i + BATCH])], ["first", "second", "third", "n"])

    def run(batches):
        bits = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        held, rows = [], 0
        for _, vocabulary, line in shards(batches, SHARD, words.value):
            h = np.array(vocabulary.hashes, np.uint64)
            may = may_be_frequent(line, h, bits, 2)
            at = np.flatnonzero(may if bits is None else may[:-1] & may[1:])
            codes, places, n = np.unique(line[at] * np.int64(len(h)) + line[at + 1], return_index=True, return_counts=True)
            if bits is not None and len(at):
                pair = np.searchsorted(codes, line[at] * np.int64(len(h)) + line[at + 1])
                _, places, n = np.unique(pair * np.int64(len(h)) + line[at + 2], return_index=True, return_counts=True)
            if len(n):
                begin = at[places]
                third = np.zeros(len(n), np.uint64) if bits is None else h[line[begin + 2]]
                held.append((h[line[begin]], h[line[begin + 1]], third, n.astype(np.int64)))
                rows += len(n)
            if rows > HELD_KEYS:
                held = [merged(held)]
                rows = len(held[0][0])
                if rows > HELD_KEYS // 2:
                    yield from given(held)
                    held, rows = [], 0
        if rows:
            yield from given(held)

    return run


def _hashed(batches):
    for batch in batches:
        keys = [batch.column(i).to_numpy().view(np.uint64) for i in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(key_hash(*keys).view(np.int64))], names=["hash"])


class Bitmap:
    """Positions as the 64-bit blocks that hold any: their numbers, ascending, and their bits."""

    __slots__ = ("blocks", "bits")

    def __init__(self, blocks: np.ndarray, bits: np.ndarray):
        self.blocks, self.bits = blocks, bits

    @classmethod
    def of(cls, positions: np.ndarray) -> Bitmap:
        """Of ascending positions."""
        blocks = positions >> 6
        first = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
        return cls(blocks[first], np.bitwise_or.reduceat(np.uint64(1) << (positions & 63).astype(np.uint64), first))

    def shifted(self) -> Bitmap:
        """Each position one on."""
        over = self.bits >> np.uint64(63)
        moved = self.bits << np.uint64(1)
        if not over.any():
            return Bitmap(self.blocks, moved)
        blocks = np.union1d(self.blocks, self.blocks[over > 0] + 1)
        bits = np.zeros(len(blocks), np.uint64)
        bits[np.searchsorted(blocks, self.blocks)] = moved
        bits[np.searchsorted(blocks, self.blocks[over > 0] + 1)] |= np.uint64(1)
        return Bitmap(blocks, bits)

    def __and__(self, other: Bitmap) -> Bitmap:
        at = np.minimum(np.searchsorted(other.blocks, self.blocks), len(other.blocks) - 1)
        bits = np.where(other.blocks[at] == self.blocks, self.bits & other.bits[at], np.uint64(0))
        kept = bits > 0
        return Bitmap(self.blocks[kept], bits[kept])

    def __len__(self) -> int:
        return int(np.bitwise_count(self.bits).sum())

    def positions(self) -> np.ndarray:
        block, bit = np.nonzero(np.unpackbits(self.bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return self.blocks[block] * 64 + bit


def phrases(line: np.ndarray, may: np.ndarray, width: int, longest: int):
    """(words' numbers, count) of the phrases of a shard of more than ``width`` words and up to ``longest`` of which all parts of ``width`` (2 or 3) words may be frequent: ``may`` at their first words."""
    starts = np.flatnonzero(may)
    if not len(starts):
        return
    size = np.int64(int(line.max()) + 1)
    codes = line[starts] * size + line[starts + 1]
    if width == 3:
        codes = np.unique(codes, return_inverse=True)[1] * size + line[starts + 2]
    order = np.argsort(codes, kind="stable")
    ends, codes = starts[order] + width - 1, codes[order]
    cut = np.concatenate([np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])), [len(codes)]])
    # Whether a phrase that ends at a place may go on.
    goes_on = np.concatenate([np.zeros(width - 2, bool), may])[: len(may)]
    by_word = np.argsort(line, kind="stable")
    first = np.searchsorted(line[by_word], np.arange(size + 1))
    bitmaps: dict[int, Bitmap] = {}

    def word(w: int) -> Bitmap:
        if w not in bitmaps:
            bitmaps[w] = Bitmap.of(by_word[first[w] : first[w + 1]])
        return bitmaps[w]

    on, at_place = goes_on.tobytes(), memoryview(line)

    def few(phrase: list[int], ends: list[int]):
        """A phrase found a few times goes on from each place."""
        ways: dict[int, list] = {}
        for end in ends:
            if on[end]:
                ways.setdefault(at_place[end + 1], []).append(end + 1)
        for w, found in ways.items():
            longer = [*phrase, w]
            yield longer, len(found)
            if len(longer) < longest:
                yield from few(longer, found)

    def deeper(phrase: list[int], found: Bitmap):
        moved = found.shifted()
        at = moved.positions()
        at = at[goes_on[at - 1]]
        # Only words that stand there are met.
        words, counts = np.unique(line[at], return_counts=True)
        for w, n in zip(words.tolist(), counts.tolist()):
            longer = [*phrase, w]
            if n <= FEW:
                ends = at[line[at] == w].tolist()
                yield longer, n
                if len(longer) < longest:
                    yield from few(longer, ends)
            else:
                met = moved & word(w)
                yield longer, len(met)
                if len(longer) < longest:
                    yield from deeper(longer, met)

    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
        begun = line[ends[i] - width + 1 : ends[i] + 1].tolist()
        yield from few(begun, ends[i:j].tolist()) if j - i <= FEW else deeper(begun, Bitmap.of(ends[i:j]))


def _long_counts(words, pairs, triples, longest: int):
    """(lang, phrase, n) of the phrases of four words or more that may be frequent."""

    def run(batches):
        two, three = (np.frombuffer(b.value, np.uint8) for b in (pairs, triples))
        counts: Counter = Counter()
        for lang, vocabulary, line in shards(batches, SHARD, words.value):
            h = np.array(vocabulary.hashes, np.uint64)
            may = may_be_frequent(line, h, three, 3, may_be_frequent(line, h, two, 2))
            for phrase, n in phrases(line, may, 3, longest):
                counts[lang, b" ".join([vocabulary.words[w] for w in phrase])] += n
                if len(counts) >= HELD_PHRASES:
                    yield _named(counts)
                    counts.clear()
        if counts:
            yield _named(counts)

    return run


def _named(counts: Counter) -> pa.RecordBatch:
    lang, phrase = zip(*counts)
    return _counts([pa.array(lang, pa.string()), pa.array([p.decode("utf-8", "surrogatepass") for p in phrase], pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "phrase", "n"])


def _spelled(keys: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, f) of keys (first, second, third, f), third being 0 or a word's hash too."""
    one = lambda i, more=(): words.select(F.col("hash").alias(("first", "second", "third")[i]), F.col("phrase").alias(f"w{i}"), *more)
    met = keys.join(one(0, ("lang",)), "first").join(one(1), "second").join(one(2), "third", "left")
    return met.select("lang", F.concat_ws(" ", "w0", "w1", "w2").alias("phrase"), "f")


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of the words and phrases found ``least`` times or more, (lang, n): all words), both written.

    Pairs and triples are summed by their words' 64-bit hashes (two of a million frequent words are
    taken for one with a probability below 1e-7), longer phrases by themselves.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    total = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("f"))
    shared = lambda hashes: spark.sparkContext.broadcast(bitmap(hashes))
    phrase, key = "lang string, phrase string, n long", "first long, second long, third long, n long"
    every = materialize(total(rows.mapInArrow(_word_counts, phrase), "lang", "phrase"))
    words = materialize(every.where(F.col("f") >= least).withColumn("hash", F.xxhash64("lang", "phrase")))
    word_bits = shared(words.select("hash"))
    found, pair_bits = [words.select("lang", "phrase", "f")], None
    for _ in range(2, min(longest, 3) + 1):
        keys = total(rows.mapInArrow(_short_counts(word_bits, pair_bits), key), "first", "second", "third")
        keys = materialize(keys.where(F.col("f") >= least))
        found.append(_spelled(keys, words))
        bits = shared(keys.select("first", "second", "third").mapInArrow(_hashed, "hash long"))
        pair_bits, triple_bits = pair_bits or bits, bits
    if longest > 3:
        longer = total(rows.mapInArrow(_long_counts(word_bits, pair_bits, triple_bits, longest), phrase), "lang", "phrase")
        found.append(longer.where(F.col("f") >= least))
    return materialize(reduce(DataFrame.unionByName, found)), materialize(every.groupBy("lang").agg(F.sum("f").alias("n")))


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of each phrase of two words or more, by its lowest-scoring cut, the first of equal ones."""
    part = F.split("phrase", " ")
    long = counts.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"))
    cuts = long.select("lang", "phrase", "a", part.alias("w"), F.explode(F.sequence(F.lit(1), F.size(part) - 1)).alias("k"))
    joined = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    known = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    met = cuts.join(known("left", "l"), ["lang", "left"]).join(known("right", "r"), ["lang", "right"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    met = met.withColumn("up", F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")).cast("decimal(34,0)")).withColumn("down", wide("l") * wide("r"))
    lowest = F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r", "n"))
    best = met.groupBy("lang", "phrase", "a").agg(lowest.alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased; pieces end at any of .,;:!? and the code points 10 to 13, words at spaces and
    tabs. A phrase counts that is found ``least`` times or more (a, overlaps included) within pieces;
    ``n`` are the language's words. The score is floor(1000 a n / (l r)), exact, l and r being the counts
    of the two parts of the cut that scores lowest, the first of equal ones. A phrase that stands inside
    a longer one found as often is left out. Ranks go by score and count, descending, then by phrase.

    Null and empty texts have no words; a null language is "und", together with those of that name.
    Repeated rows count each. Other columns are ignored, ids too, whatever their names. Texts and
    pieces of any length are read whole. Empty gives empty.
    """
    with temporary(docs.sparkSession) as written:
        counts, totals = phrase_counts(docs, lang_col, text_col, least, longest)
        found = scored(counts, totals)
        # If a longer phrase holds one as often, so does one that is a word longer.
        w = F.split("phrase", " ")
        longer = counts.where(F.size(w) > 2).select("lang", "f", F.explode(F.array(F.array_join(F.slice(w, 2, F.size(w)), " "), F.array_join(F.slice(w, 1, F.size(w) - 1), " "))).alias("phrase"))
        held = longer.groupBy("lang", "phrase").agg(F.max("f").alias("a"))
        kept = found.join(held, ["lang", "phrase", "a"], "left_anti")
        order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
        result = materialize(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
        written.pop()
    return result
