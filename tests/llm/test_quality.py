import re
import zlib
from collections import Counter

import numpy as np
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.llm import quality_fm, quality_rules, queries

from .fixtures import documents, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) for k in range(5) if windows[tuple(words[i : i + 5])] > 1}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b \x1cé", max_size=80))
def test_statistics_match_brute_force(text):
    assert quality_rules.text_statistics(text) == brute(text)


def brute_bands(raw):
    """(ratio, n_chunks, n_chunks_off, in the bands), from the bytes of a text."""
    size = lambda b: len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(b)) / len(b)
    inside = lambda n, x, bands: [low <= x <= high for most, low, high in bands if n < most][0]
    if not raw:
        return 1.0, 0, 0, False
    chunks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
    off = sum(not inside(len(c), size(c), quality_rules.CHUNK_BANDS) for c in chunks)
    return size(raw), len(chunks), off, off == 0 and inside(len(raw), size(raw), quality_rules.DOCUMENT_BANDS)


def mixed_texts():
    """Texts of many lengths: clean, with a repetitive or noisy stretch in the middle or in the last part of a chunk."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("etaoinshrdlucmfwyp"), rng.integers(2, 9))) for _ in range(2000)]
    clean = lambda n: " ".join(rng.choice(words, n))
    texts = [clean(n) for n in (1, 5, 10, 30, 100, 300, 600, 700, 760, 1500, 9000)]
    texts += [clean(1500) + " " + "ab " * 1300 + clean(1500), clean(1500)[:8192] + "z" * 600, clean(800)[:4096] + "".join(map(chr, rng.integers(33, 0x2FF, 400)))]
    return texts + [None, "", "x", "x" * 50_000]


def test_statistics_and_verdicts_match_brute_force(spark):
    rows = [(i, t) for i, t, *_ in documents()] + list(enumerate(mixed_texts(), 100))
    found = quality_rules.quality_statistics(spark.createDataFrame(rows, "doc_id long, text string"))
    want = []
    for i, t in rows:
        base, raw = brute(t or ""), (t or "").encode()
        ratio, n, off, inside = brute_bands(raw)
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        want.append((i, *base, len(raw), ratio, n, off, failed, inside and not failed))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    verdict = {i: w[-1] for i, w in zip((r[0] for r in rows), want)}
    assert [verdict[i] for i in (105, 106, 110)] == [True] * 3 and not any(verdict[i] for i in (111, 112, 113, 117))


def test_query_agrees_with_brute_force(spark, tmp_path):
    rows = list(enumerate(mixed_texts()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_chunks"], r["n_chunks_off"], r["kept"]) for r in queries.op3_compression_bands(spark, str(tmp_path)).collect()}
    for i, t in rows:
        base, (_, n, off, inside) = brute(t or ""), brute_bands((t or "").encode())
        assert got[i] == (n, off, inside and base[0] >= 10 and 100 * base[4] <= 20 * base[0])


def test_ids_keep_their_type(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", None)], "doc_id string, text string")
    assert {r["doc"] for r in quality_rules.quality_statistics(docs).collect()} == {"a", "b"}


def test_bands_reject_repetition_and_noise(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("etaoinshrdlucmfwyp"), rng.integers(2, 9))) for _ in range(2000)]
    clean = " ".join(rng.choice(words, 600)) + "."
    noise = " ".join("".join(chr(c) for c in rng.integers(33, 0x2FF, 12)) for _ in range(600))
    cycle = " ".join(str(i % 100) + "ab" for i in range(600))
    kept = {r["doc"]: r["kept"] for r in quality_rules.quality_statistics(spark.createDataFrame([(1, clean), (2, noise), (3, cycle)], "doc_id long, text string")).collect()}
    assert kept == {1: True, 2: False, 3: False}


def test_whole_text_shows_what_chunks_do_not():
    """A passage longer than a chunk comes again and again, a quarter of its words changed: each chunk is usual."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("etaoinshrdlucmfwyp"), rng.integers(2, 9))) for _ in range(2000)]
    passage, parts = rng.choice(words, 900), []
    for _ in range(10):
        copy = passage.copy()
        copy[rng.integers(0, 4) :: 4] = rng.choice(words, len(copy[0::4]))
        parts.append(" ".join(copy))
    raw = " ".join(parts).encode()
    compressor = zstandard.ZstdCompressor(level=quality_rules.LEVEL, write_content_size=False)
    n_bytes, ratio, n, off = quality_rules.compression(raw, compressor)
    assert off == 0 and n > 10 and ratio < quality_rules.band(n_bytes, quality_rules.DOCUMENT_BANDS)[0]
    assert not quality_rules.verdict_of((0, *quality_rules.text_statistics(raw.decode()), n_bytes, ratio, n, off))


def test_one_odd_chunk_of_many_is_kept(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshrdlucmfwyp"), rng.integers(2, 9))) for _ in range(2000)]
    clean = " ".join(rng.choice(words, 30_000)).encode()
    text = lambda chunks, odd: (clean[: 4096 * (chunks - odd)] + b"-" * (4096 * odd)).decode()
    rows = [(1, text(19, 1)), (2, text(20, 1)), (3, text(39, 2)), (4, text(40, 2)), (5, text(20, 0))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc"]: (r["n_chunks"], r["n_chunks_off"], r["kept"]) for r in quality_rules.quality_statistics(docs).collect()}
    assert found == {1: (19, 1, False), 2: (20, 1, True), 3: (39, 2, False), 4: (40, 2, True), 5: (20, 0, True)}
    assert sorted(r["doc_id"] for r in quality_rules.keep_quality(docs).collect()) == [2, 4, 5]


def test_keep_quality_agrees(spark):
    docs = table(spark)
    kept = quality_rules.keep_quality(docs)
    assert kept.columns == docs.columns
    verdicts = Counter((r["doc"]) for r in quality_rules.quality_statistics(docs).where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == verdicts
    assert quality_rules.keep_quality(table(spark, [])).count() == 0
    assert quality_rules.quality_statistics(table(spark, [])).count() == 0


def test_words_that_share_a_bucket_are_one_feature():
    by_bucket = {}
    for w in (f"w{i}" for i in range(60_000)):
        by_bucket.setdefault(zlib.crc32(w.encode()) % quality_fm.BUCKETS, []).append(w)
    words = next(ws for ws in by_bucket.values() if len(ws) > 3)[:3]
    index, value = quality_fm.features(" ".join(words), None)
    assert len(set(index.tolist())) == len(index) and (index < quality_fm.BUCKETS).sum() == 1
    assert np.isclose(value[index < quality_fm.BUCKETS], 1.0).all()


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(2)
    index, value = np.array([3, 8, 20]), rng.normal(size=3)
    model = {"w0": 0.3, "w": rng.normal(size=30), "v": rng.normal(size=(30, 4))}
    slow = 0.3 + sum(model["w"][i] * x for i, x in zip(index, value))
    slow += sum(model["v"][index[a]] @ model["v"][index[b]] * value[a] * value[b] for a in range(3) for b in range(a + 1, 3))
    assert np.isclose(quality_fm.raw_score(model, index, value), slow)


def test_classifier_learns_and_holds_out(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(300)]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(words, 60)) + "."
        rows.append((i, text if i % 4 else re.sub(r"(\w) ", r"\1### | ", text), None, None, None, 0, 0, 0))
    docs = table(spark, rows + documents()[2:6])
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_fm.train(docs, labels)
    got = quality_fm.score_quality(docs, model).collect()
    assert len(got) == 404 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc"]).encode()) % 5 == 0) for r in got if r["doc"] is not None)
    held = [r for r in got[:400] if r["held_out"] and r["doc"] is not None]
    assert np.mean([r["predicted"] == int(r["doc"] % 4 != 0) for r in held]) > 0.95
    assert quality_fm.score_quality(table(spark, []), model).count() == 0


def test_untrained_model_scores_half(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_fm.train(table(spark), none)
    assert {round(r["score"], 1) for r in quality_fm.score_quality(table(spark), model).collect()} <= {0.4, 0.5, 0.6}
