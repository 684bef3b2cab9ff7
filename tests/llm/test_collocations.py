"""Phrases against plain counts; bitmaps against sets."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import collocations as C

from .fixtures import documents, table

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, longest, best):
    """(text, lang) to the rows of ``collocations``."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                own.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    found = []
    for lang, own in f.items():
        own = {p: a for p, a in own.items() if a >= least}
        inside = {}
        for p, a in own.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(a, inside.get(p[i:j], 0))
        rows = []
        for p, a in own.items():
            if len(p) > 1 and inside.get(p, 0) < a:
                cuts = [(1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:best], 1):
            found.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def shown(df):
    return sorted(tuple(r) for r in df.collect())


def prose(seed, n, words=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Éa", "日本", "B-c", "the", "THE", "of", "the of"]
    return ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "!", ": "]) for _ in range(rng.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("least, longest, best", [(1, 5, 10_000), (3, 5, 40), (2, 3, 7), (4, 2, 1000), (2, 6, 500)])
def test_phrases_against_plain_counts(spark, least, longest, best):
    rng = random.Random(1)
    rows = [(t, rng.choice(["en", "fr", "und", None])) for t in prose(2, 150)] + [(None, "en"), ("", None), (" \n.,", "xx"), ("solo", "xx")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert shown(C.collocations(df, least=least, longest=longest, best=best)) == brute(rows, least, longest, best)


def test_fixtures_clashing_names_and_empty(spark):
    rows = [(r[1], r[2]) for r in documents()]
    named = table(spark).withColumnsRenamed({"doc": "phrase", "node": "n"}).withColumn("f", F.lit("x")).withColumn("hash", F.lit(0))
    assert shown(C.collocations(named, least=2)) == brute(rows, 2, 5, 2000)
    found = C.collocations(table(spark, []))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.collect() == []


def test_shards_are_cut_where_no_phrase_stands(spark, monkeypatch):
    rows = [(" ".join(prose(3, 40)), "en"), ("one two three four five " * 400, "en"), *[(t, "fr") for t in prose(4, 30)]]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    words = C.shards
    for size in (16, 100, 1000):
        monkeypatch.setattr(C, "SHARD", size)
        assert shown(C.collocations(df, least=2)) == brute(rows, 2, 5, 2000)
    assert words is C.shards


@pytest.mark.parametrize("few", [0, 2, 32])
@pytest.mark.parametrize("size, width", [(16, 2), (64, 3), (1 << 19, 2), (1 << 19, 3)])
def test_kernel_in_shards_of_any_size(size, width, few, monkeypatch):
    monkeypatch.setattr(C, "FEW", few)
    text = "\n".join(prose(5, 60))
    stretch = C._Stretch("en", None)
    stretch.add(text)
    stretch.parse()
    counted = Counter()
    for _, vocabulary, line in stretch.cut(size):
        hashes = np.array(vocabulary.hashes, np.uint64)
        may = C.may_be_frequent(line, hashes, None, 2)
        may = may if width == 2 else C.may_be_frequent(line, hashes, None, 3, may)
        for phrase, n in C.phrases(line, may, width, 5):
            counted[b" ".join(vocabulary.words[w] for w in phrase).decode()] += n
    want = Counter()
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text.translate(UPPER)):
        words = re.findall(r"[^ \t]+", piece)
        for m in range(width + 1, 6):
            want.update(" ".join(words[i : i + m]) for i in range(len(words) - m + 1))
    assert counted == want


def test_bitmaps_are_sets():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, rng.integers(2, 900), rng.integers(1, 80))) for _ in range(2))
        x, y = C.Bitmap.of(a), C.Bitmap.of(b)
        assert x.positions().tolist() == a.tolist() and len(x) == len(a)
        assert x.shifted().positions().tolist() == (a + 1).tolist()
        both = x & y
        assert both.positions().tolist() == sorted(set(a.tolist()) & set(b.tolist())) and len(both) == len(set(a.tolist()) & set(b.tolist()))


def test_hashes_are_those_of_spark(spark):
    words = ["été", "a", "", "日本" * 30, "x" * 200]
    found = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64(F.lit("fr"), "w").alias("h")).collect()
    vocabulary = C.Vocabulary("fr", None)
    for r in found:
        assert vocabulary.hashes[vocabulary[r["w"].encode()]] == r["h"] % (1 << 64)


def test_scores_pass_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 3_000_000_000_000), ("en", "b", 2_999_999_999_999), ("en", "a b", 2_000_000_000_001)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 900_000_000_000_007)], "lang string, n long")
    (r,) = C.scored(counts, totals).collect()
    assert r["score"] == 1000 * 2_000_000_000_001 * 900_000_000_000_007 // (3_000_000_000_000 * 2_999_999_999_999)


def test_equal_cuts_take_the_first(spark):
    counts = spark.createDataFrame([("en", p, f) for p, f in [("a", 5), ("b", 5), ("c", 5), ("a b", 5), ("b c", 5), ("a b c", 5)]], "lang string, phrase string, f long")
    found = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in C.scored(counts, spark.createDataFrame([("en", 50)], "lang string, n long")).collect()}
    assert found["a b c"] == (5, 5, 10_000)
