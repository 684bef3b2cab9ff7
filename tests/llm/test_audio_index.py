"""The inverted index of fingerprints against the search over all offsets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import audio_index, audio_match, chroma, queries


def noisy(rng, ints, share):
    return ints ^ np.packbits(rng.random((len(ints), 32)) < share, axis=1).view("<u4")[:, 0]


def table(spark, prints):
    """A fingerprint table of id to integers."""
    rows = [(i, len(p), bytearray(np.asarray(p, "<u4").tobytes())) for i, p in prints]
    key = lambda seed: F.when(F.col("n_ints") > 0, F.xxhash64(F.lit(seed), "fingerprint"))
    return spark.createDataFrame(rows, "id long, n_ints long, fingerprint binary").withColumn("k1", key(1)).withColumn("k2", key(2))


def pairs(matches):
    return {(r["class_id"], r["match_id"]): (r["offset"], round(r["bit_error"], 9)) for r in matches.collect()}


def test_errors_of_many_offsets_are_those_of_each(monkeypatch):
    monkeypatch.setattr(audio_index, "COMPARED", 50)
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (5, 40, 1)]
    b = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (30, 7, 1)]
    pair, offset = (x.ravel() for x in np.meshgrid(np.arange(3), np.arange(-45, 46), indexing="ij"))
    error, places = audio_index.errors_at(a, b, pair, pair, offset)
    for i, (p, d) in enumerate(zip(pair, offset)):
        want, n = chroma.bit_error(a[p], b[p], int(d))
        assert places[i] == n and error[i] == pytest.approx(want)


def test_filed_places_leave_runs_and_loops_out():
    assert audio_index.filed_places(np.array([], np.uint32)).tolist() == []
    assert audio_index.filed_places(np.array([7, 7, 7, 8, 7], np.uint32)).tolist() == [0, 3, 4]
    loop = np.tile(np.array([1, 2], np.uint32), audio_index.REPEATS + 1)
    assert audio_index.filed_places(np.append(loop, 9)).tolist() == [2 * audio_index.REPEATS + 2]


def test_index_finds_what_the_full_search_finds(spark, monkeypatch):
    """Shifted, cut and noisy copies, loops and held tones, in small slices."""
    for limit in ("ASKED", "COUNTED", "COMPARED"):
        monkeypatch.setattr(audio_index, limit, 3000)
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (74, 74, 60, 900)]
    prints = [*base]
    for share in (0.01, 0.03, 0.06):
        for b in base:
            prints += [noisy(rng, b, share), noisy(rng, b[11:], share), noisy(rng, b, share)[: len(b) - 9]]
    loop = np.tile(rng.integers(0, 2**32, 3, dtype=np.uint32), 400)
    prints += [np.full(80, 5, np.uint32), np.full(70, 5, np.uint32), np.full(60, 7, np.uint32), loop, noisy(rng, loop, 0.05), loop[4:200], base[0][:2], []]
    shown = table(spark, list(enumerate(prints)))
    asked = F.col("id") % 3 == 0
    members, matches = audio_match.match_recordings(shown, asked)
    got = pairs(matches)
    want = pairs(audio_match.match_recordings(shown, asked, exact=True)[1])
    plain = {i for i, p in enumerate(prints) if len(p) and len(audio_index.filed_places(np.asarray(p, np.uint32))) * audio_index.LEAST_RARE < len(p)}
    assert len(plain) >= 4 and {k for k in want if plain & set(k)} == {k for k in got if plain & set(k)}
    assert got.keys() <= want.keys() and len(got) >= 0.95 * len(want) and len(want) > 40
    assert sum(got[k] == want[k] for k in got) >= 0.95 * len(got)
    assert members.count() == len(prints)
    once = pairs(audio_match.match_recordings(shown.repartition(5), asked)[1])
    assert once == got


def test_frequent_integers_are_searched_without_the_index(monkeypatch):
    """Recordings that share most integers with a third of all."""
    monkeypatch.setattr(audio_index, "LEAST_FREQUENT", 3)
    rng = np.random.default_rng(3)
    theme = rng.integers(0, 2**32, 60, dtype=np.uint32)
    prints = [noisy(rng, theme, 0.002) for _ in range(20)] + [rng.integers(0, 2**32, 60, dtype=np.uint32) for _ in range(38)]
    prints += [noisy(rng, prints[30], 0.02), np.append(prints[31][:40], prints[32][:20])]
    raw = [p.astype("<u4").tobytes() for p in prints]
    indexed = audio_match._Indexed(list(range(len(raw))), raw)
    assert np.flatnonzero(indexed.index.plain).tolist() == list(range(20))
    got, want = set(indexed.all_matches(prints)), set(audio_match._Block(list(range(len(raw))), raw).all_matches(prints))
    assert {x[:3] for x in got} == {x[:3] for x in want} and len(got) == len(want) and {(0, 19), (30, 58)} <= {x[:2] for x in want}


def test_histogram_counts_each_offset():
    """Against a count by hand, up to one and two differing bits, with repeated integers."""
    rng = np.random.default_rng(5)
    filed = [rng.integers(0, 8, n, dtype=np.uint32) * np.uint32(3) for n in (30, 9, 50)]
    found = [rng.integers(0, 8, n, dtype=np.uint32) * np.uint32(3) for n in (20, 1, 40)]
    for flips in (0, 1, 2):
        index = audio_index.Index(filed, flips)
        want = set()
        for i, a in enumerate(filed):
            for j, b in enumerate(found):
                hits = [int(x) - y for x in audio_index.filed_places(a) for y in range(len(b)) if int(a[x] ^ b[y]).bit_count() <= flips]
                want |= {(i, j, d) for d in set(hits) if hits.count(d) >= audio_index.LEAST_HITS}
        assert not index.plain.any() and set(zip(*(x.tolist() for x in index.agreed(found)))) == want and want


def test_registered_query_against_all_offsets(spark, tmp_path):
    """Embeddings with noisy and equal copies, nulls, empty and longer ones: recall of at least 0.9, no false match."""
    rng = np.random.default_rng(4)
    base = [rng.normal(size=64) for _ in range(30)]
    vectors = [*base, *(v + rng.normal(0, 0.03, 64) for v in base), *(np.append(v, rng.normal(size=20)) for v in base), base[0], None, [], np.zeros(64)]
    rows = [(50 * i if i % 2 else 50 * i + 1, None if v is None else [float(x) for x in v], i) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op9_chroma_fingerprints(spark, str(tmp_path)).collect()
    members = {r["vec_id"]: r["class_id"] for r in found if r["match_id"] is None}
    assert len(members) == len(rows)
    prints = {i: chroma.fingerprint(chroma.samples(audio_match.tones(v))) for i, v, _ in rows if v}
    classes = {}
    for i in sorted(prints):
        classes.setdefault(prints[i].tobytes(), i)
    assert all(members[i] == (classes[prints[i].tobytes()] if i in prints else None) for i in members)
    asked = {members[i] for i in members if i % 50 == 0 and members[i] is not None}
    want = {(q, c): hit for q in asked for c in classes.values() if q != c and (hit := audio_match.align(prints[q], prints[c], range(-len(prints[c]) + 1, len(prints[q]))))}
    got = {(r["class_id"], r["match_id"]): (r["offset"], r["bit_error"]) for r in found if r["match_id"] is not None}
    assert got.keys() <= want.keys() and len(got) >= 0.9 * len(want) and len(want) > 30
    # A third verified offset may be the better one, never a worse error than the best.
    assert all(got[k][1] >= want[k][1] - 1e-12 for k in got)
