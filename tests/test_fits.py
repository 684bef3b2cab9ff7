"""Quantiles against sums, linkage against the plain search."""

import itertools
import math
import time

import numpy as np
import pytest

from helixframe.operators import fit


@pytest.mark.parametrize("size, mean", [(0.3, 5.0), (4.0, 60.0), (60.0, 100.0), (1e6, 40.0), (math.inf, 3.5), (math.inf, 900.0), (2.5, 20_000.0), (0.01, 0.5)])
def test_quantiles_equal_the_walk(size, mean):
    k = np.arange(400_000 if mean > 1000 else 20_000, dtype=float)
    total = np.exp(fit.nb_log_probability(k, size, mean)).cumsum()
    for p in (0.001, 0.1, 0.5, 0.9, 0.999):
        assert fit.nb_quantile(p, size, mean) == int(np.searchsorted(total, p))
    for at in (0, 1, int(mean), int(2 * mean)):
        assert fit.nb_share(at, size, mean) == pytest.approx(total[at], rel=1e-7)


def test_quantiles_have_no_end():
    for size, mean in ((50.0, 3e9), (math.inf, 4e7), (2.0, 1e12)):
        q = fit.nb_quantile(0.9, size, mean)
        assert fit.nb_share(q, size, mean) >= 0.9 > fit.nb_share(q - max(1, int(1e-6 * q)), size, mean)
    assert fit.nb_quantile(0.5, 3.0, 0.0) == 0


def plain_linkage(far, cut):
    groups = [{i} for i in range(len(far))]
    while len(groups) > 1:
        d, i, j = min((max(far[x, y] for x in a for y in b), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(groups), 2))
        if d > cut:
            break
        groups[i] |= groups.pop(j)
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("seed", range(6))
def test_complete_linkage(seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 1, (9, 3)) for c in rng.normal(0, 4, (4, 3))])
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for cut in (0.5, 2.0, 4.0, 100.0):
        found = fit.complete_linkage(far, cut)
        assert {frozenset(np.flatnonzero(found == g).tolist()) for g in set(found.tolist())} == plain_linkage(far, cut)
    assert fit.complete_linkage(np.empty((0, 0)), 1.0).tolist() == []


def test_two_thousand_samples_take_seconds():
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (2000, 4))
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    began = time.perf_counter()
    found = fit.complete_linkage(far, 1.0)
    assert time.perf_counter() - began < 30
    for g in np.unique(found):
        own = np.flatnonzero(found == g)
        assert far[np.ix_(own, own)].max() <= 1.0


def test_fits_of_all_regions_at_once(spark, monkeypatch):
    """Every region's fit is that of its own counts, however many are taken together."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(40):
        size, mean = rng.uniform(0.5, 40), rng.uniform(1, 300)
        x = rng.negative_binomial(size, size / (size + mean), rng.integers(1, 60)) if k % 5 else np.full(4, 7)
        rows += [(f"c{k % 3}", k * 10, float(v), float(rng.integers(0, 50))) for v in x]
    df = spark.createDataFrame(rows, "chr string, start long, cov double, weight double")
    want = {}
    for key in {r[:2] for r in rows}:
        own = np.array([r[2:] for r in rows if r[:2] == key and r[3] > 0])
        if len(own):
            want[key] = fit.fit_nb(own[:, 0], own[:, 1])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        for most in (1, 100, 1 << 17):
            monkeypatch.setattr(fit, "FIT_ROWS", most)
            got = {(r["chr"], r["start"]): (r["size"], r["mean"]) for r in fit.weighted_nb_fit(df).collect()}
            assert set(got) == set(want)
            for key, (size, mean) in want.items():
                assert got[key] == (pytest.approx(size, rel=1e-9), pytest.approx(mean, rel=1e-12))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_registered_fit_of_similar_samples(spark):
    from helixframe.operators import normalize
    from helixframe.plans import catalogue

    folder = "/root/testdata/sf0.001"
    rows = catalogue._plain(spark, folder)
    weighted = fit.similarity_weights(rows, normalize.sample_correlation(rows).selectExpr("a", "b", "0.5 + r / 2 AS r"))
    own = {}
    for r in weighted.select("target", "chr", "start", "cov", "weight").collect():
        own.setdefault((r["target"], r["chr"], r["start"]), []).append((r["cov"], float(r["weight"])))
    got = {(r["target"], r["chr"], r["start"]): (r["size"], r["mean"]) for r in catalogue.queries()["similar_samples_fit"](spark, folder).collect()}
    assert set(got) == set(own) and got
    for key, counts in own.items():
        x = np.array(counts)
        size, mean = fit.fit_nb(x[:, 0], x[:, 1])
        assert got[key] == (pytest.approx(size, abs=1e-4, rel=1e-6), pytest.approx(mean, abs=1e-4))


def test_points_in_long_regions_are_few_rows(spark):
    from helixframe.operators import intervals

    rng = np.random.default_rng(3)
    regions = [(f"c{k % 2}", a := int(rng.integers(0, 4_000_000)), a + int(10 ** rng.uniform(0, 9)), k) for k in range(200)]
    points = [(k, f"c{k % 2}", int(10 ** rng.uniform(0, 9))) for k in range(300)]
    met = intervals.points_in_regions(spark.createDataFrame(points, "site long, chr string, pos long"), spark.createDataFrame(regions, "chr string, start long, end long, id long"), 100)
    assert sorted((r["site"], r["id"]) for r in met.collect()) == sorted((s, k) for s, c, p in points for d, a, b, k in regions if c == d and a <= p <= b)


def test_trimming_compares_the_number_itself(spark):
    """5.7 is inside a limit of 5, 5 is not, though both are counted as 5."""
    found = {r["value"]: (r["n"], r["part"]) for r in fit.histogram(spark.createDataFrame([(5.7,), (5.0,), (5.2,), (7.0,), (None,)], "c double"), "c").collect()}
    assert found == {5: (3, 2), 7: (1, 0)}
    rng = np.random.default_rng(6)
    x = rng.gamma(20, 5, 800).round(1)
    inside = x
    for _ in range(6):
        size, mean = fit.fit_nb(*np.unique(np.floor(inside), return_counts=True))
        low, high = fit.nb_quantile(0.1, size, mean), fit.nb_quantile(0.9, size, mean)
        inside = inside[(inside > low) & (inside < high)]
    want = fit.fit_nb(*np.unique(np.floor(inside), return_counts=True))
    got = fit.trimmed_fit(spark.createDataFrame([(float(v),) for v in x], "c double"), "c")
    assert got == (pytest.approx(want[0], rel=1e-9), pytest.approx(want[1]), len(inside))


def test_mixture_of_counts_and_equal_deviations():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(100, 4, 900), rng.normal(70, 4, 300), rng.normal(130, 4, 300)])
    values, n = np.unique(x.round(), return_counts=True)
    for found in (fit.mixture(x), fit.mixture(values, n)):
        weight, mean, sd = found
        order = np.argsort(mean)
        assert mean[order] == pytest.approx([70, 100, 130], abs=1) and weight[order] == pytest.approx([0.2, 0.6, 0.2], abs=0.03)
        assert np.ptp(sd) < 1e-9  # one deviation for all explains as much with fewer numbers
    uneven = np.concatenate([rng.normal(100, 12, 900), rng.normal(40, 1, 900)])
    assert np.ptp(fit.mixture(uneven)[2]) > 5
    twice = fit.mixture(np.repeat(values, n))
    assert all(np.allclose(a, b, rtol=1e-6) for a, b in zip(twice, fit.mixture(values, n)))


def test_registered_purity_against_its_rows(spark):
    """The query's estimates are those of each sample's own coverage, taken whole."""
    from helixframe.plans import catalogue

    folder = "/root/testdata/sf0.001"
    own = {}
    for r in catalogue._plain(spark, folder).select("sample", "cov").collect():
        own.setdefault(r["sample"], []).append(r["cov"])
    found = {r["sample"]: (r["purity"], r["score"]) for r in catalogue.queries()["purity_mixture"](spark, folder).collect()}
    assert set(found) == set(own)
    for sample, x in own.items():
        x = np.array(x)
        inside = x[(x > x.mean() / 2) & (x < 2 * x.mean())]
        count, edge = np.histogram(inside if len(inside) else x, 200)
        normal = (edge[count.argmax()] + edge[count.argmax() + 1]) / 2
        weight, peak, _ = fit.mixture(*np.unique(x, return_counts=True))
        usual = np.abs(weight - weight.mean()) < (weight.std(ddof=1) if len(weight) > 1 else math.nan)
        peak = peak[(peak > 0.25 * normal) & (peak < 1.75 * normal) & usual]
        best = min(((sum(min(abs(t * c * normal + (1 - t) * normal - p) for c in (0.5, 1, 1.5)) for p in peak), t) for t in np.round(np.arange(0.02, 1.001, 0.01), 2)))
        purity, score = found[sample]
        assert (purity is None and not len(peak)) or (score == pytest.approx(best[0], abs=1e-3) and len(peak))
