"""Work in ranges against loops, with chromosomes that lie in many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import intervals, ranges, segments, variants


@pytest.fixture
def many_ranges(spark):
    """Every exchange has many partitions, none of which are joined again."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def loop_groups(rows, most):
    """{(key, start, end) in order: group} of sorted rows."""
    found, key, at, n = [], None, None, 0
    for name, a, b in rows:
        if (name,) != key:
            key, at, n = (name,), None, 0
        if a is not None and b is not None and (at is None or b - at > most):
            at, n = a, n + 1
        found.append((name, a, b, n))
    return found


@pytest.mark.parametrize("kind", ["tiles", "gaps", "nested", "one"])
def test_greedy_groups_in_many_ranges(spark, many_ranges, kind):
    rng = random.Random(kind)
    make = {
        "tiles": lambda k: (k * 10, k * 10 + 9), "gaps": lambda k: (k * 7 + 400 * (k // 50), k * 7 + 400 * (k // 50) + rng.randrange(1, 90)),
        "nested": lambda k: (rng.randrange(3000), rng.randrange(3000, 3400) if rng.random() < 0.02 else None), "one": lambda k: (5, rng.randrange(6, 300)),
    }[kind]
    rows = [(c, *make(k)) for c in ("a", "b", None) for k in range(250)]
    rows = [(c, a, a + rng.randrange(1, 60) if b is None and rng.random() < 0.9 else b) for c, a, b in rows]
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2] is not None, r[2] or 0))
    df = spark.createDataFrame(rows, "chr string, start long, end long")
    for most in (0, 25, 100):
        got = intervals.greedy_groups(df, most)
        want = loop_groups(rows, most)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    dealt = ranges.deal(df, "chr", "start", "end")
    assert dealt.where("chr = 'a'").select("__range").distinct().count() > 2 or kind == "one"


def test_running_and_following(spark, many_ranges):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), k, rng.randrange(100) if rng.random() < 0.8 else None) for k in range(300)]
    dealt = ranges.deal(spark.createDataFrame(rows, "key string, at long, v long"), "key", "at")
    found = ranges.running(dealt, ("key",), ("at",), "total", F.col("v"))
    found = ranges.running(found, ("key",), ("at",), "most", F.col("v"), F.max, itself=False)
    found = ranges.following(found, ("key",), ("at",), "after", F.col("v"))
    got = {r["at"]: (r["total"], r["most"], r["after"]) for r in found.collect()}
    for key in ("x", "y", None):
        own = [(at, v) for k, at, v in rows if k == key]
        for i, (at, _) in enumerate(own):
            before = [v for _, v in own[:i] if v is not None]
            upto = [v for _, v in own[: i + 1] if v is not None]
            assert got[at] == (sum(upto) if upto else None, max(before, default=None), own[i + 1][1] if i + 1 < len(own) else None)


def test_clusters_of_samples_in_many_ranges(spark, many_ranges):
    """Two samples at one position are looked at alone."""
    rng = random.Random(3)
    rows = [(rng.choice(["s1", "s2"]), rng.choice(["1", "2"]), rng.randrange(900), rng.choice(["SNV", "SNV", "Deletion"]), rng.choice(["PASS", "PASS", "q22.5"]), k) for k in range(400)]
    got = variants.flag_clusters(spark.createDataFrame(rows, "sample string, chr string, pos long, type string, filter string, id long"), 6, ("id",), by=("sample",))
    want = {}
    for sample in ("s1", "s2"):
        for c in ("1", "2"):
            own, last, before = sorted((r for r in rows if r[:2] == (sample, c)), key=lambda r: (r[2], r[5])), None, None
            for r in own:
                want[r[5]] = r[4]
                if r[3] == "SNV" and r[4] == "PASS":
                    if last is not None and r[2] - last < 6:
                        want[r[5]] = "Cluster6bp"
                        if before is not None:
                            want[before] = "Cluster6bp"
                    else:
                        last = r[2]
                before = r[5]
    assert {r["id"]: r["filter"] for r in got.collect()} == want
    best = variants.best_per_position(spark.createDataFrame([("s1", "1", 5, 0.2, 1), ("s2", "1", 5, 0.4, 2), ("s1", "1", 5, 0.3, 3)], "sample string, chr string, pos long, af double, id long"), ("id",), by=("sample",))
    assert sorted(r["id"] for r in best.collect()) == [2, 3]


def test_unified_segments(spark, many_ranges):
    """Against a walk over positions."""
    rng = random.Random(4)
    rows = [(c, rng.choice("AB") + "x", a := rng.randrange(120), a + rng.randrange(-1, 14)) for c in ("1", "2") for _ in range(40)] + [("1", "Cx", 5, 5), ("1", "Cx", None, 9), ("3", "Ax", 1, 4), ("3", "Ax", 5, 9)]
    got = variants.unified_segments(spark.createDataFrame(rows, "chr string, caller string, start long, end long"), by=("chr",))
    want = []
    for c in ("1", "2", "3"):
        held = None
        for pos in range(-1, 140):
            now = ",".join(sorted({k for x, k, a, b in rows if x == c and a is not None and a <= pos <= b}))
            if held and now == held[3]:
                held[2] = pos
            else:
                if held and held[3]:
                    want.append((*held, len(held[3].split(","))))
                held = [c, pos, pos, now]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert variants.unified_segments(spark.createDataFrame([], "chr string, caller string, start long, end long"), by=("chr",)).collect() == []


def test_unified_calls(spark):
    rows = [("a", 3.0, 5, 2.0, 4.0), ("b", 3.0, 5, 4.0, 4.0), ("c", 2.0, 90, None, None), ("d", -1.0, 90, None, None), ("e", 12.0, 20, None, None), ("f", 12.0, 26, None, None), ("g", 12.0, None, None, None), ("h", None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, cn double, probes int, weight double, norm_weight double")
    assert sorted(r["id"] for r in variants.unified_calls(df).collect()) == ["a", "f", "g", "h"]


def test_allele_frequency_of_sites(spark):
    """30 of 40 reads are 0.75 and 40 of 40 are 1; with compat 30 to 10 is 3 and 40 to 0 is none."""
    sites = spark.createDataFrame([("s", "1", 0, 30, 10, 0.5), ("s", "1", 0, 40, 0, 0.25), ("s", "1", 9, 0, 0, 0.5)], "sample string, chr string, start long, alt_count long, ref_count long, pop_het double")
    show = lambda df: {r["start"]: (r["snp_sum"], r["snp_known"], r["snp_weight"]) for r in df.collect()}
    assert show(segments.site_sums(sites)) == {0: (pytest.approx(0.5 * 0.75 + 0.25), 0.75, 0.75), 9: (None, None, 0.5)}
    assert show(segments.site_sums(sites, compat=True)) == {0: (pytest.approx(1.5), 0.5, 0.75), 9: (None, None, 0.5)}
