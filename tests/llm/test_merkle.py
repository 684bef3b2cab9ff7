"""The manifest against a plain tree, with runs so short that several passes are needed."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helixframe.llm import merkle

from .fixtures import documents, table


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(level):
    """All levels of the tree over a list of digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, pos):
    """(sibling or None, whether it is on the left) for each level below the root."""
    found = []
    for level in levels[:-1]:
        other = pos ^ 1
        found.append((level[other] if other < len(level) else None, other < pos))
        pos //= 2
    return found


def brute(rows, tampered):
    """Rows (doc_id, text, lang, source, n_chars) to sorted (doc, grp, pos, leaf, subroot, root, proof, folded, verified)."""
    leaf = lambda d, t, g, s, n: h(*map(field, (d, s, g, n, t)))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    found = []
    for i, g in enumerate(names):
        for pos, (_, _, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = path(trees[g], pos) + path(top, i)
            now = leaf(*r[:4], r[4] + 1) if r[4] is not None and r[0] is not None and tampered(r[0]) else own
            for sibling, left in steps:
                now = h(now) if sibling is None else h(sibling, now) if left else h(now, sibling)
            found.append((r[0], g, pos, own, trees[g][-1][0], top[-1][0], h(*[s for s, _ in steps if s]), now, now == top[-1][0]))
    return sorted(found, key=repr)


def touched():
    return {"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("run_bits", [1, 2, 10])
def test_manifest_against_plain_tree(spark, run_bits):
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in documents()]
    found = merkle.manifest(table(spark), tampered=touched(), run_bits=run_bits)
    assert found.columns == ["doc", "grp", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert shown(found) == brute(rows, lambda i: i % 3 == 0)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 33])
def test_groups_of_all_sizes(spark, n):
    rng = random.Random(n)
    rows = [(i if rng.random() < 0.9 else None, rng.choice(["", None, "x" * 20_000, f"text {i}"]), rng.choice(["en", "", None, "é", "de"]) if n > 8 else "en", None, rng.choice([None, i])) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert shown(merkle.manifest(df, tampered=touched(), run_bits=2)) == brute(rows, lambda i: i % 3 == 0)


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = [(7, "same", "en", "a", 4)] * 50 + [(8, "other", "en", "a", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = shown(merkle.manifest(df, run_bits=3))
    assert found == brute(rows, lambda i: False) and all(r[-1] for r in found)
    assert sorted(r[2] for r in found) == list(range(51))


def test_null_columns_and_values_differ(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (1, "", "", "", 0), (1, "-", "-", "-", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.manifest(df).collect()
    assert len({r["leaf"] for r in found}) == len({r["subroot"] for r in found}) == 3 and all(r["verified"] for r in found)


def test_clashing_names_and_empty(spark):
    rows = table(spark).withColumnsRenamed({"doc": "grp", "node": "pos"}).withColumn("digest", F.lit(1)).withColumn("upper", F.lit(2))
    assert shown(merkle.manifest(rows)) == shown(merkle.manifest(table(spark)))
    assert merkle.manifest(table(spark, [])).collect() == []


def test_nodes_are_stored_by_level(spark, tmp_path):
    leaves = spark.createDataFrame([("g", i, 11, h(str(i))) for i in range(11)], "grp string, pos long, n long, digest string")
    passes, roots = merkle.build(leaves, str(tmp_path / "store"), run_bits=2)
    levels = tree([h(str(i)) for i in range(11)])
    stored = {(2 * p + r["level"], r["pos"]): r["digest"] for p in range(len(passes)) for r in spark.read.parquet(str(tmp_path / f"store/pass={p}")).collect()}
    assert stored == {(k, i): d for k, level in enumerate(levels) if k for i, d in enumerate(level)}
    assert [tuple(r) for r in roots.collect()] == [("g", levels[-1][0])]
