import random

import numpy as np
import pytest

from helixframe.llm import near_dedup, superminhash
from helixframe.operators.graph import UnionFind, connected_components

from .fixtures import documents, table


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    rows = [(i, shingles(t)) for i, t in rows]
    sets = UnionFind()
    known = [(i, s) for i, s in rows if s and i is not None]
    for a, (i, s) in enumerate(known):
        for j, t in known[a + 1 :]:
            both = len(s & t)
            if 100 * both >= 85 * (len(s) + len(t) - both):
                sets.union(i, j)
    return sorted(((i, len(s), None if i is None else sets.find(i) if s else i) for i, s in rows), key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    for similarity in (0.5, 0.85):
        got = []
        for _ in range(60):
            n = 300
            common = round(2 * n * similarity / (1 + similarity))
            u = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            got.append((superminhash.signature(np.unique(u[:n])) == superminhash.signature(np.unique(u[n - common :]))).mean())
        assert abs(np.mean(got) - similarity) < 0.02
        assert np.std(got) < (similarity * (1 - similarity) / superminhash.SLOTS) ** 0.5  # independent hashes' deviation


def test_early_stop_changes_nothing():
    x = np.unique(np.random.default_rng(1).integers(0, 2**63, 700, dtype=np.uint64))
    best = superminhash.signature(x)
    assert np.isfinite(best).all()
    assert np.isfinite(superminhash.signature(x[:1])).all() and (np.sort(np.floor(superminhash.signature(x[:1]))) == np.arange(superminhash.SLOTS)).all()


def test_fixture_matches_brute_force(spark):
    docs = table(spark)
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(((r["doc"], r["n_shingles"], r["component"]) for r in got), key=str) == brute([(r[0], r[1]) for r in documents()])
    assert all(r["kept"] == (r["doc"] is None or r["doc"] == r["component"]) for r in got)
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("block", [400_000, 300])
def test_groups_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(near_dedup, "LEADER_SHINGLES", block)
    rng = random.Random(4)
    rows = []
    for g in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(80)]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = f"z{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc"], r["n_shingles"], r["component"]) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)


def test_spanning_links_connect_what_is_similar():
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 4, 8, 12, 500, 503)]
    found = near_dedup.spanning_links(list(range(6)), range(6), [0] * 6, sets, 85)
    groups = UnionFind()
    for a, b in found:
        groups.union(a, b)
    assert [groups.find(i) for i in range(6)] == [0, 0, 0, 0, 4, 4] and len(found) == 4
    assert near_dedup.spanning_links([0, 1], [0, 1], [0, 1], sets[:2], 85) == [(0, 1)]
    # What is known to be one group is not linked again, but what joins it is.
    assert near_dedup.spanning_links(list(range(4)), [0, 0, 2, 2], [0] * 4, sets[:4], 85) == [(0, 2)] or len(near_dedup.spanning_links(list(range(4)), [0, 0, 2, 2], [0] * 4, sets[:4], 85)) == 1
    assert near_dedup.leader_links([0, 1, 2, 4], [sets[i] for i in (0, 1, 2, 4)], 0, 85) == [(1, 0), (2, 0)]


def chain(n, seed=9, words=60, fresh=14):
    """Documents of which each shares most words with the one before: candidates hang together, links are few."""
    rng = random.Random(seed)
    now, rows = [f"w{rng.randrange(10**6)}" for _ in range(words)], []
    for i in range(n):
        rows.append((i, " ".join(now)))
        now = now[fresh:] + [f"w{rng.randrange(10**6)}" for _ in range(fresh)]
    return rows


def test_work_grows_with_a_percolating_graph(spark, monkeypatch):
    dealt = []
    verified = near_dedup._verified

    def counted(rows, roles, *rest):
        dealt.append(roles.selectExpr("coalesce(sum(size(roles)), 0) as n").first()["n"])
        return verified(rows, roles, *rest)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(near_dedup, "LEADER_SHINGLES", 300)
    sent = []
    for n in (60, 180):
        rows = chain(n)
        got = sorted(((r["doc"], r["n_shingles"], r["component"]) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
        assert got == brute(rows)
        sent.append(sum(dealt))
        dealt.clear()
    assert sent[0] > 60 and sent[1] <= 4 * sent[0]


@pytest.mark.parametrize("block", [400_000, 200])
def test_members_that_miss_the_leader_are_linked(spark, monkeypatch, block):
    """Near copies drift from the first, so that members of a band link with each other and not with its smallest."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(near_dedup, "LEADER_SHINGLES", block)
    rng = random.Random(2)
    rows = []
    for g in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        for k in range(14):
            words = base[: 100 - 6 * (k % 7)] + [f"g{g}k{k % 7}x{j}" for j in range(6 * (k % 7))]
            words[rng.randrange(50)] = f"z{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(words)))
    got = sorted(((r["doc"], r["n_shingles"], r["component"]) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(600, 640)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = UnionFind()
    for a, b in edges:
        sets.union(a, b)
    assert got == {x: sets.find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    plain = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), contract=False).collect()}
    assert plain == got
