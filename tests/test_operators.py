import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixframe.functions import genome, model
from helixframe.operators import cohort, fit, graph, hmm, intervals, likelihood, normalize, segments, variants
from helixframe.plans.caller import CallerConfig, call


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize("x", [0.001, 0.5, 1.0, 3.7, 12.0, 1e3, 1e6])
def test_lgamma(spark, x):
    assert value(spark, genome.lgamma(F.lit(x))) == pytest.approx(math.lgamma(x), rel=1e-11, abs=1e-11)


def test_erf_and_tails(spark):
    for x in (-2.0, -0.3, 0.0, 0.7, 3.0):
        assert value(spark, genome.erf(F.lit(x))) == pytest.approx(math.erf(x), abs=2e-7)


def test_nb_sums_to_one(spark):
    total = spark.range(3000).select(F.sum(F.exp(genome.nb_log_pmf(F.col("id").cast("double"), F.lit(40.0), F.lit(3.5)))).alias("s")).collect()[0]["s"]
    assert total == pytest.approx(1, abs=1e-9)


def test_beta_cdf_by_integration(spark):
    for a, b in ((0, 0), (3, 7), (20, 1), (60, 400), (12, 90)):
        x = np.linspace(0, 0.1, 200_001)
        density = (a + b + 1) * math.comb(a + b, a) * x**a * (1 - x) ** b
        assert value(spark, genome.beta_cdf(0.1, F.lit(a), F.lit(b))) == pytest.approx(float(np.trapezoid(density, x)), rel=1e-6, abs=1e-12)


def test_beta_cdf_at_any_depth(spark):
    """A site of 8000 reference reads surely lies below 0.1, one of 8000 alternative reads above."""
    assert value(spark, genome.beta_cdf(0.1, F.lit(0), F.lit(8000))) == pytest.approx(1.0)
    assert value(spark, genome.beta_cdf(0.1, F.lit(8000), F.lit(0))) == 0.0
    assert value(spark, genome.beta_cdf(0.1, F.lit(10_000), F.lit(90_000))) == pytest.approx(0.5, abs=0.01)
    exact = sum(math.comb(501, i) * 0.1**i * 0.9 ** (501 - i) for i in range(61, 502))
    assert value(spark, genome.beta_cdf(0.1, F.lit(60), F.lit(440))) == pytest.approx(exact, rel=1e-9)


def test_autosomes(spark):
    names = ["1", "chr22", "23", "X", "chrX", "0"]
    rows = spark.createDataFrame([(n,) for n in names], "chr string")
    assert [r["chr"] for r in intervals.keep_autosomes(rows).collect()] == ["1", "chr22"]


def test_chr_rank(spark):
    names = ["chr10", "2", "X", "MT", "1", "Y", "chr3", "scaffold"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").orderBy(genome.chr_rank(F.col("n"))).collect()
    assert [r["n"] for r in rows] == ["1", "2", "chr3", "chr10", "X", "Y", "MT", "scaffold"]


def test_transition_constants():
    m = model.transitions()
    assert m[0] == pytest.approx([0.86186, 0.00345, 0.12522, 0.00345, 0.00172, 0.00086, 0.00345], abs=1e-5)
    assert m[2] == pytest.approx(model.prior()) and model.false_positive() == pytest.approx(0.00278597, abs=1e-8)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(0, 10_000))
def test_viterbi_is_the_cheapest_path(n, seed):
    rng = np.random.default_rng(seed)
    states = ("0", "1", "2", "3")
    costs = rng.exponential(2, (n, 4))
    far = np.concatenate([[np.inf], rng.uniform(0, 120_000, n - 1)])
    path, cost = hmm.viterbi(costs, far, states)

    def total(p):
        t = -math.log(model.prior(states)[p[0]]) + costs[0, p[0]]
        for i in range(1, n):
            t += model.transition_costs(far[i], states)[p[i - 1], p[i]] + costs[i, p[i]]
        return t

    assert cost == pytest.approx(min(total(p) for p in itertools.product(range(4), repeat=n)))
    assert total(path) == pytest.approx(cost)


def random_regions(seed, n):
    rng = random.Random(seed)
    return [(i, rng.choice("ab"), s := rng.randrange(500), s + rng.randrange(120)) for i in range(n)]


@pytest.mark.parametrize("width", [7, 100, 1000])
def test_overlaps_match_nested_loops(spark, width):
    a, b = random_regions(1, 40), random_regions(2, 40)
    df = lambda rows: spark.createDataFrame(rows, "id long, chr string, start long, end long")
    got = sorted((r["a_id"], r["b_id"]) for r in intervals.overlaps(df(a), df(b), width).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    points = [(i, c, p) for i, c, p, _ in a]
    met = intervals.points_in_regions(spark.createDataFrame(points, "site long, chr string, pos long"), df(b), width)
    assert sorted((r["site"], r["id"]) for r in met.collect()) == sorted((i, y[0]) for i, c, p in points for y in b if c == y[1] and y[2] <= p <= y[3])


def test_bins_end_as_described(spark):
    sizes = spark.createDataFrame([("a", 25), ("b", 20), ("c", 7)], "chr string, chr_size long")
    got = sorted((r["chr"], r["start"], r["end"]) for r in intervals.genome_bins(sizes, 10).collect())
    assert got == [("a", 0, 9), ("a", 10, 19), ("a", 20, 25), ("b", 0, 9), ("b", 10, 19), ("b", 20, 20), ("c", 0, 6)]
    # An overlap moves a window's start back; a chromosome of just one width is one window.
    sizes = spark.createDataFrame([("d", 25, 0), ("e", 10, 1)], "chr string, chr_size long, chr_place long")
    bins = intervals.genome_bins(sizes, 10, 3)
    assert sorted((r["chr"], r["start"], r["end"]) for r in bins.collect()) == [("d", 0, 9), ("d", 7, 19), ("d", 17, 25), ("e", 0, 9)]
    swapped = spark.createDataFrame([("d", 1), ("e", 0)], "chr string, chr_place long")
    assert [r["chr"] for r in intervals.dictionary_order(bins, swapped).collect()] == ["e", "d", "d", "d"]


def test_long_intervals_take_few_rows(spark):
    """An interval of a whole chromosome meets short ones without being cut into their width."""
    long = spark.createDataFrame([(0, "a", 0, 200_000_000), (1, "a", 5_000, 5_100)], "id long, chr string, start long, end long")
    assert intervals._cuts(long.selectExpr("chr a_chr", "start a_start", "end a_end"), "a", 100).count() < 40
    short = spark.createDataFrame([(i, "a", i * 1000, i * 1000 + 50) for i in range(200)], "id long, chr string, start long, end long")
    got = sorted((r["a_id"], r["b_id"]) for r in intervals.overlaps(long, short, 100).collect())
    assert got == [(0, i) for i in range(200)] + [(1, 5)]


def test_depth_of_regions_counts_every_overlap(spark):
    reads = [("s", "a", i * 7, i * 7 + 20) for i in range(30)] + [("t", "b", 5, 9)]
    regions = [("a", 10, 40), ("a", 0, 500), ("b", 10, 20), ("a", 0, 500)]
    got = {(r["sample"], r["chr"], r["start"], r["end"]): r["n_reads"] for r in intervals.region_depth(spark.createDataFrame(reads, "sample string, chr string, start long, end long"), spark.createDataFrame(regions, "chr string, start long, end long"), 16).collect()}
    assert got == {(s, *r): sum(x[0] == s and x[1] == r[0] and x[2] <= r[2] and r[1] <= x[3] for x in reads) for s in "st" for r in regions}


def test_pairs_meet_at_the_longer_ones_level_alone(spark):
    """Short intervals far apart are no pairs of the wide levels' joins, and samples don't make partitions meet all partitions."""
    short = spark.createDataFrame([(i, "a", i * 10_000, i * 10_000 + 50) for i in range(400)], "id long, chr string, start long, end long")
    met = intervals.overlaps(short, short, 100)
    assert met.count() == 400
    keys = lambda p: intervals._cuts(short.selectExpr(f"chr {p}_chr", f"start {p}_start", f"end {p}_end"), p, 100, spark.sql("SELECT array(0) __met"))
    assert {r["__at"] for r in keys("a").collect()} == {0}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = short.withColumn("sample", F.lit("s")).select("sample", "chr", "start", "end")
        plan = intervals.region_depth(rows, short, 100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan


def test_callers_by_region_make_no_pairs(spark):
    """Against nested loops: repeated ids, places and regions, regions without a name, a segment that ends before it starts; a pile takes rows, not pairs."""
    a = [*((i % 50, c, s, e) for i, c, s, e in random_regions(3, 60)), (70, "a", 30, 20), (71, None, 1, 5), (72, "a", 10**6, 10**6 + 5)]
    b = [(c, s, e, f"n{i % 5}" if i % 7 else None) for i, c, s, e in random_regions(4, 60)]
    b += [*b[:9], ("a", 0, 90, "whole"), ("b", 9, 4, "back")]
    found = variants.callers_by_region(spark.createDataFrame(a, "id long, chr string, start long, end long"), spark.createDataFrame(b, "chr string, start long, end long, region_name string"), 50)
    want = {}
    for i, c, s, e in a:
        for d, t, f, n in b:
            if c == d and s <= f and t <= e:
                want.setdefault(i, []).append(n)
    assert {r["id"]: (r["region_names"], r["n_regions"]) for r in found.collect()} == {i: (",".join(sorted({n for n in v if n})), len(v)) for i, v in want.items()}
    pile = spark.range(60_000).selectExpr("id", "'a' AS chr", "id % 50 AS start", "id % 50 + 900 AS end")
    piled = variants.callers_by_region(pile, pile.selectExpr("chr", "start", "end", "concat('n', id % 3) AS region_name"), 100)  # 3.6e9 pairs
    assert [tuple(r) for r in piled.select("region_names", "n_regions").distinct().collect()] == [("n0,n1,n2", 60_000)] and piled.count() == 60_000


def reciprocal(x, y, share):
    shared = min(x[3], y[3]) - max(x[2], y[2]) + 1
    return x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3] and shared >= share * (x[3] - x[2] + 1) and shared >= share * (y[3] - y[2] + 1)


@pytest.mark.parametrize("share", [0.05, 0.6, 1.0])
def test_reciprocal_pairs_match_nested_loops(spark, share):
    a, b = [*random_regions(6, 80), (90, "a", 100, 102), (91, "a", 9, 5)], [*random_regions(7, 80), (90, "a", 100, 104), (91, None, 1, 4)]
    df = lambda rows: spark.createDataFrame(rows, "id long, chr string, start long, end long")
    got = sorted((r["a_id"], r["b_id"]) for r in intervals.reciprocal_pairs(df(a), df(b), share).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if reciprocal(x, y, share))
    odd = lambda rows: df(rows).withColumn("g", F.col("id") % 3)
    got = sorted((r["a_id"], r["b_id"]) for r in intervals.reciprocal_pairs(odd(a), odd(b), share, group="g").collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if x[0] % 3 != y[0] % 3 and reciprocal(x, y, share))


def test_population_frequency_of_piles(spark):
    """The best entry against nested loops; calls and entries of few places take no pair each."""
    a, b = random_regions(8, 70), random_regions(9, 70)
    df = lambda rows: spark.createDataFrame([(*r, "DEL" if r[0] % 2 else "DUP") for r in rows], "id long, chr string, start long, end long, svtype string")
    entries = df(b).unionByName(df(b).withColumn("id", F.col("id") + 200)).withColumns({"ac": F.col("id"), "af": F.col("id") / 1000})
    best = {x[0]: min(((-(min(x[3], y[3]) - max(x[2], y[2])), y[0]) for y in b if x[0] % 2 == y[0] % 2 and reciprocal(x, y, 0.6)), default=(0, None))[1] for x in a}
    assert {r["id"]: r["ac"] for r in variants.population_frequency(df(a), entries, 50).collect()} == best
    pile = spark.range(60_000).selectExpr("id", "'a' AS chr", "id % 50 AS start", "id % 50 + 900 AS end", "'DEL' AS svtype")
    found = variants.population_frequency(pile, pile.withColumns({"ac": F.col("id"), "af": F.lit(0.5)}), 100)  # 3.6e9 pairs
    assert found.where("ac = id % 50").count() == 60_000


@pytest.mark.parametrize("seed, share", [(21, 0.6), (22, 0.9), (23, 0.0)])
def test_merged_calls_match_a_loop(spark, seed, share):
    """Repeated places and ids, calls that end before they start or lack a chromosome."""
    rows = [*random_regions(seed, 90), *[(i + 100, *r[1:]) for i, r in enumerate(random_regions(seed, 9))], (3, "b", 480, 600), (120, "a", 50, 40), (121, None, 3, 9), (122, None, 3, 9)]
    rows = [(*r, "DEL" if r[2] % 3 else "DUP") for r in rows]
    group = {r[0]: r[0] for r in rows}
    for _ in rows:
        for x in rows:
            for y in rows:
                if x[4] == y[4] and x[1] is not None and reciprocal(x, y, share):
                    group[x[0]] = group[y[0]] = min(group[x[0]], group[y[0]])
    got = variants.merge_overlapping(spark.createDataFrame(rows, "id long, chr string, start long, end long, svtype string"), 50, share)
    assert {r["id"]: r["group"] for r in got.collect()} == group and got.count() == len(group)


def test_piles_are_merged_without_their_pairs(spark):
    pile = spark.range(60_000).selectExpr("id", "'a' AS chr", "id % 300 AS start", "id % 300 + 900 + id % 40 AS end", "'DEL' AS svtype")
    found = variants.merge_overlapping(pile, 100)  # 1.8e9 pairs
    assert found.where("group = 0").count() == 60_000


def test_greedy_groups_match_a_loop(spark):
    rows = sorted({(s, e) for _, _, s, e in random_regions(5, 30)})
    got = [(r["start"], r["group"]) for r in intervals.greedy_groups(spark.createDataFrame([("a", s, e) for s, e in rows], "chr string, start long, end long"), 100).orderBy("start", "end").collect()]
    want, at, n = [], None, 0
    for s, e in rows:
        if at is None or e - at > 100:
            at, n = s, n + 1
        want.append((s, n))
    assert got == want


def test_library_size_keeps_the_mean(spark):
    rows = [("s1", "a", i, i + 9, i * 3 + 1) for i in range(20)] + [("s2", "a", i, i + 9, 7) for i in range(20)] + [("s3", "a", 0, 9, 0)]
    out = normalize.library_size(spark.createDataFrame(rows, "sample string, chr string, start long, end long, cov_raw long"))
    overall = sum(r[4] for r in rows) / len(rows)
    assert out.where("sample = 's1'").agg(F.avg("cov")).collect()[0][0] == pytest.approx(overall)
    assert out.where("sample = 's3'").collect()[0]["cov"] is None


def test_costs_are_distributions(spark):
    df = spark.createDataFrame([(float(k),) for k in (0, 1, 50, 100, 5000)], "cov double")
    for out in (likelihood.nb_coverage(df, F.lit(60.0), F.lit(900.0)), likelihood.normal_coverage(df, F.lit(60.0), F.lit(9.0))):
        for r in out.collect():
            assert sum(math.exp(-x) for x in r["nll"]) == pytest.approx(1)
    snps = spark.createDataFrame([(0, 30, 0.4), (15, 15, 0.5), (30, 0, 0.0), (0, 0, 0.5)], "alt_count long, ref_count long, pop_het double")
    for load in (1.0, 0.5):
        for r in likelihood.snp_states(snps, load).collect():
            assert len(r["nll"]) == 7 and sum(math.exp(-x) for x in r["nll"]) == pytest.approx(1)


def test_run_lengths_rebuild_the_input(spark):
    rng = random.Random(7)
    rows = [("s", "a", i * 10, i * 10 + 9, rng.choice("122"), 1.0) for i in range(50)]
    out = segments.run_lengths(spark.createDataFrame(rows, "sample string, chr string, start long, end long, cn_pred string, cov double")).orderBy("start").collect()
    want, n = [], 0
    for i, r in enumerate(rows):
        n += i == 0 or r[4] != rows[i - 1][4]
        want.append(n)
    assert [r["cn_id"] for r in out] == want


def simulated(spark, load=1.0):
    rng = np.random.default_rng(11)
    rows = []
    for sample in ("s1", "s2", "s3"):
        for chr_ in ("1", "2"):
            for i in range(120):
                copies = 2
                if sample == "s1" and chr_ == "1" and 40 <= i < 60:
                    copies = 4
                if sample == "s2" and chr_ == "2" and 80 <= i < 110:
                    copies = 1
                mean = 200 * (load * copies / 2 + 1 - load)
                rows.append((sample, chr_, i * 50_000, i * 50_000 + 49_999, int(rng.negative_binomial(80, 80 / (80 + mean)))))
    return spark.createDataFrame(rows, "sample string, chr string, start long, end long, cov_raw long")


def checked(found):
    """Whether the longest changed segment of each chromosome is what was planted, and what s3 has is short."""
    longest = {(r["sample"], r["chr"]): (r["cn_pred"], r["start"] // 50_000, r["end"] // 50_000) for r in sorted(found, key=lambda r: r["length"])}
    up, down = longest["s1", "1"], longest["s2", "2"]
    assert up[0] in ("3", "4", "5") and abs(up[1] - 40) <= 4 and abs(up[2] - 59) <= 4
    assert down[0] == "1" and abs(down[1] - 80) <= 4 and abs(down[2] - 109) <= 4
    assert not any(r["length"] > 500_000 and r["sample"] == "s3" for r in found)


def test_caller_finds_planted_changes(spark):
    called = call(simulated(spark), CallerConfig(library="wgs"))
    checked(called.segments.collect())
    assert called.errors.count() == 0 and called.too_frequent.count() == 0
    assert {"sample", "chr", "start", "end", "cn_pred", "cov_raw", "cov"} == set(called.cohort.columns)


def test_caller_uses_regions_bands_gc_and_cohort(spark):
    coverage = simulated(spark)
    places = coverage.select("chr", "start", "end").distinct()
    regions = places.where("start >= 100000").withColumn("region_name", F.concat(F.lit("r"), (F.col("start") / 500_000).cast("int"))).withColumn("region_id", F.col("start"))
    bands = spark.createDataFrame([("1", 4_000_000, 4_400_000, "acen"), ("1", 0, 10, "gneg")], "chr string, start long, end long, band_type string")
    gc = places.select("chr", "start", (0.3 + F.pmod(F.xxhash64("chr", "start"), F.lit(100)) / 500).alias("gc"))
    first = call(coverage.where("sample != 's3'"), CallerConfig(library="wgs"), regions=regions)
    called = call(coverage.where("sample = 's3' or sample = 's1'"), CallerConfig(library="wgs", most_in_cohort=0.4), regions=regions, bands=bands, gc=gc, cohort=first.cohort)
    rows = called.regions.cache()
    assert {r["sample"] for r in rows.select("sample").distinct().collect()} == {"s1", "s3"}
    assert rows.where("start < 100000").count() == 0 and rows.where("chr = '1' and start between 3960001 and 4439999").count() == 0
    assert rows.agg(F.max("samples_in_cohort")).first()[0] == 3
    assert called.segments.where("sample = 's1' and chr = '1'").orderBy(F.desc("length")).first()["region_names"].startswith("r4,r5")
    assert {r["sample"] for r in called.cohort.select("sample").distinct().collect()} == {"s1", "s2", "s3"}


def test_recurrent_calls_are_made_normal(spark):
    rows = simulated(spark).withColumn("cov_raw", F.when((F.col("chr") == "2") & (F.col("start") < 1_000_000), F.lit(400).cast("long")).otherwise(F.col("cov_raw")))
    called = call(rows, CallerConfig(library="wgs", most_in_cohort=0.7))
    gone = called.too_frequent.select("sample", "chr", "start").distinct()
    assert gone.where("chr = '2' and start < 1000000").count() >= 45
    assert called.segments.where("chr = '2' and start < 900000 and length > 500000").count() == 0


def test_similar_samples_and_sites(spark):
    """A panel of ten like samples; in one a stretch has lost one allele of its heterozygous sites, in one a copy."""
    rng = np.random.default_rng(5)
    level = rng.uniform(50, 500, 240)
    rows, sites = [], []
    for n in range(10):
        for i in range(240):
            copies = 1 if n == 4 and 30 <= i < 60 else 2
            rows.append((f"s{n}", "1", i * 1000, i * 1000 + 999, int(rng.poisson(level[i] * copies / 2 * 5))))
            share = 1.0 if n in (4, 7) and 30 <= i < 60 else 0.5
            alt = int(rng.binomial(60, share))
            sites.append((f"s{n}", "1", i * 1000 + 500, alt, 60 - alt, 0.5))
    coverage = spark.createDataFrame(rows, "sample string, chr string, start long, end long, cov_raw long")
    spots = spark.createDataFrame(sites, "sample string, chr string, pos long, alt_count long, ref_count long, pop_het double")
    called = call(coverage, CallerConfig(), sites=spots)
    found = {(r["sample"], r["cn_pred"]): (r["start"] // 1000, r["end"] // 1000, r["snp_weight"]) for r in called.segments.where("length > 20000").collect()}
    assert set(found) == {("s4", "1"), ("s7", "LOH")}
    assert all(abs(a - 30) <= 1 and abs(b - 59) <= 1 and weight == 0.5 * (b - a + 1) for a, b, weight in found.values())


def test_failing_samples_are_left_out(spark):
    rows = spark.createDataFrame([(s, c, i * 10, i * 10 + 9, 5.0, [0.1] * (2 if s == "bad" and c == "2" else 3)) for s in ("good", "bad") for c in "12" for i in range(4)], "sample string, chr string, start long, end long, cov double, nll array<double>")
    kept, errors = hmm.without_failures(hmm.decode(rows, ("1", "2", "3"), isolate=True).cache())
    assert {r["sample"] for r in kept.collect()} == {"good"} and kept.count() == 8
    assert [(r["sample"], r["chr"]) for r in errors.collect()] == [("bad", "2")] and "costs are missing" in errors.first()["error"]
    with pytest.raises(Exception, match="costs are missing"):
        hmm.decode(rows, ("1", "2", "3")).count()


def test_purity_loop(spark):
    called = call(simulated(spark, 0.7), CallerConfig(library="wgs", calling="tumor_only"))
    got = {r["sample"]: r["load"] for r in called.purities.collect()}
    assert got["s2"] == pytest.approx(0.7, abs=0.15) and got["s1"] == pytest.approx(0.7, abs=0.3)
    assert CallerConfig().initial_load == 1.0 and CallerConfig().iterations == 1 and CallerConfig(calling="tumor_normal").iterations == 3


def test_nb_fit_recovers(spark):
    rng = np.random.default_rng(2)
    x = rng.negative_binomial(4, 4 / (4 + 60), 20_000)
    values, n = np.unique(x, return_counts=True)
    size, mean = fit.fit_nb(values.astype(float), n.astype(float))
    assert size == pytest.approx(4, rel=0.05) and mean == pytest.approx(60, rel=0.05)
    assert fit.nb_quantile(0.5, 4.0, 60.0) == pytest.approx(np.median(x), abs=2)
    assert fit.fit_nb(np.array([5.0]), np.array([9.0]))[0] == math.inf
    size, mean, used = fit.trimmed_fit(spark.createDataFrame([(int(v),) for v in x[:4000]], "c long"), "c")
    assert 0 < used < 4000 and 30 < mean < 70


def test_fisher_values():
    p, odds = fit.fisher_exact(3, 1, 1, 3)
    assert p == pytest.approx(0.4857142857) and odds == pytest.approx(6.408309, rel=1e-5)
    assert fit.fisher_exact(5, 0, 0, 5) == (pytest.approx(0.007936508), math.inf)


def test_mixture_finds_peaks(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(100, 3, 600), rng.normal(70, 3, 200), rng.normal(130, 3, 150)])
    _, mean, _ = fit.mixture(x)
    assert all(min(abs(mean - m)) < 3 for m in (70, 100, 130))
    df = spark.createDataFrame([("s", float(v)) for v in x], "sample string, cov double")
    assert fit.purity_prior(df).collect()[0]["purity"] == pytest.approx(0.6, abs=0.05)


def test_sample_clusters_and_weights(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(100, 20, 60)
    other = rng.normal(100, 20, 60)
    rows = [(s, "a", i, float(b[i] + rng.normal(0, 1))) for s, b in (("x", base), ("y", base), ("z", other)) for i in range(60)]
    cov = spark.createDataFrame(rows, "sample string, chr string, start long, cov double")
    r = normalize.sample_correlation(cov)
    weights = {(x["a"], x["b"]): x["weight"] for x in r.collect()}
    assert weights["x", "y"] > 0.8 and weights["x", "z"] == 0 and weights["x", "x"] == 1
    groups = fit.sample_clusters(r)
    assert groups["x"] == groups["y"] != groups["z"]
    moments = normalize.weighted_moments(cov, r)
    assert moments.where("sample = 'z'").agg(F.max("w_sd")).collect()[0][0] == 1.0
    weighted = fit.similarity_weights(cov, r.where("a = 'x'"))
    assert fit.weighted_nb_fit(weighted.withColumn("cov", F.bround("cov"))).count() == 60


def test_groups_follow_chains(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101)]
    ids = spark.createDataFrame([(i,) for i in [*range(41), 100, 101, 200]], "id long")
    got = {r["id"]: r["group"] for r in graph.smallest_reachable(ids, spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


def test_cohort_rules(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "sample string, x int")
    earlier = spark.createDataFrame([("b", 9), ("c", 3)], "sample string, x int")
    got = sorted(map(tuple, cohort.with_cohort(batch, earlier).select("sample", "x", "type").collect()))
    assert got == [("a", 1, "call"), ("b", 2, "call"), ("c", 3, "cohort")]
    assert value(spark, cohort.copies(F.lit("LOH"))) == 2


def test_vcf_lines_parse_back(spark):
    seg = spark.createDataFrame([("1", 10, 20, -1.5), ("1", 30, 40, 0.0), ("2", 5, 9, 0.8)], "contig string, start long, end long, log2 double")
    lines = variants.vcf_lines(variants.segment_copy_numbers(seg))
    info = lines.select(variants.vcf_info(F.col("value")).alias("i")).collect()
    assert [(r["i"]["SVTYPE"], r["i"]["END"], r["i"]["SVLEN"]) for r in info] == [("DEL", "20", "11"), ("COPY_NORMAL", "40", "11"), ("DUP", "9", "5")]
    assert variants.vcf_header(date="2024-01-02")[:2] == ["##fileformat=VCFv4.2", "##fileDate=2024-01-02"]


def test_type_follows_the_number_that_is_not_corrected(spark):
    """log2 of 1.7 / 2 is 1.7 copies, normal, though a tumour content of a half makes it 1.4."""
    rows = [(math.log2(1.7 / 2),), (math.log2(0.4 / 2),), (math.log2(2.6 / 2),), (0.0,)]
    got = variants.segment_copy_numbers(spark.createDataFrame(rows, "log2 double"), 0.5).collect()
    assert [(r["cn"], r["ccn"], r["svtype"], r["gt"]) for r in got] == [(1.7, 1.4, "COPY_NORMAL", "0/0"), (0.4, -1.2, "DEL", "1/1"), (2.6, 3.2, "DUP", "0/1"), (2.0, 2.0, "COPY_NORMAL", "0/0")]


def test_deep_sites_tell_states_apart(spark):
    sites = spark.createDataFrame([(600, 600, 1.0), (400, 800, 1.0), (0, 8000, 1.0), (0, 8000, 0.5)], "alt_count long, ref_count long, pop_het double")
    costs = [r["nll"] for r in likelihood.snp_states(sites).orderBy("alt_count", "pop_het").collect()]
    best = lambda c: model.STATES[1:][int(np.argmin(c[1:]))]
    assert best(costs[3]) == "2" and best(costs[2]) == "3" and best(costs[1]) in ("1", "LOH")
    # Half the weight is on a homozygous site, which is as likely in every state.
    assert max(costs[0]) < 4 and max(costs[1]) > 5


def test_rows_are_fine_by_their_bin_or_their_own_height(spark):
    """Ten regions of one GC bin are far too high: in a full bin they are out, in a bin with few such they stay, and low ones always do."""
    rows = [("s", "1", i, i + 1, 100.0, 0.4) for i in range(400)] + [("s", "1", 1000 + i, 1001 + i, 900.0, 0.5) for i in range(15)] + [("s", "1", 2000 + i, 2001 + i, 900.0, 0.6) for i in range(14)] + [("s", "1", 3000, 3001, 0.0, 0.5)]
    kept = normalize.gc_outliers(spark.createDataFrame(rows, "sample string, chr string, start long, end long, cov_norm double, gc double"), deviations=3.0)
    starts = {r["start"] for r in kept.collect()}
    assert starts == {r[2] for r in rows if not 1000 <= r[2] < 2000}


def test_genotype_probabilities(spark):
    """Priors of a site with pop_het 1/2 and 12 of 12 reads alternative, and of 6 of 12."""
    got = variants.genotype_classes(spark.createDataFrame([(12, 0, 0.5), (6, 6, 0.5)], "alt_count long, ref_count long, pop_het double")).orderBy("alt_count").collect()
    quad, tri = 0.5 * 0.005 / 3, 0.5 * 0.01 / 2
    prior = [0.25, quad, tri, 0.5 - 2 * quad - 2 * tri, tri, quad, 0.25]
    for r, alt in zip(got, (6, 12)):
        like = [w * p**alt * (1 - p) ** (12 - alt) for w, p in zip(prior, (0, 0.25, 0.33, 0.5, 0.66, 0.75, 1))]
        share = [x / sum(like) for x in like]
        assert [r["hom_prob"], r["het_prob"], r["tri_prob"], r["quad_prob"]] == pytest.approx([share[0] + share[6], share[3] - 2 * quad, share[2] + share[4], 4 * quad])
        assert r["vaf"] == alt / 12


def test_no_copies_have_a_level_of_their_own(spark):
    p = likelihood.nb_copy_states(spark.createDataFrame([(0.0,), (3.0,), (100.0,)], "cov double"), F.lit(100.0), F.lit(20.0)).collect()
    pmf = lambda k, m, r: math.exp(math.lgamma(k + r) - math.lgamma(r) - math.lgamma(k + 1) + r * math.log(r / (r + m)) + k * math.log(m / (r + m)))
    for r, k in zip(p, (0, 3, 100)):
        raw = [pmf(k, 1, 0.1)] + [pmf(k, 50 * c, 20 * (c / 2) ** 2) for c in (1, 2, 3, 4)]
        assert r["probabilities"] == pytest.approx([x / sum(raw) for x in raw])


def test_normal_levels_and_purity(spark):
    """Regions of one copy at half the level speak for the level too; the longest change implies the purity."""
    rows = [("s", "1", i * 10, i * 10 + 9, "2", 100.0) for i in range(5)] + [("s", "1", 50 + i * 10, 59 + i * 10, "1", 70.0) for i in range(6)] + [("s", "1", 200, 209, "0", 0.0)]
    calls = segments.run_lengths(spark.createDataFrame(rows, "sample string, chr string, start long, end long, cn_pred string, cov double")).withColumn("sd_distance", F.lit(0.0))
    assert segments.normal_levels(calls).first()["norm_cov"] == 140.0  # 100 five times, 140 six times
    rolled = segments.rollup(calls)
    assert {r["cn_pred"]: r["length"] for r in rolled.collect()} == {"2": 49, "1": 59, "0": 9}
    flat = segments.normal_levels(calls.withColumn("cov", F.when(F.col("cn_pred") == "1", 50.0).otherwise(F.col("cov"))))
    got = segments.purity(rolled, flat, segments.genome_size(calls), 1).first()
    assert flat.first()["norm_cov"] == 100.0 and got["purity"] == pytest.approx((70 / 100 - 1) / (1 / 2 - 1)) and got["genome_percent"] == round(100 * 59 / 209, 2)


@pytest.mark.parametrize("n, middle", [(10, None), (11, 6), (12, 6), (13, 6), (14, 7), (17, 8), (19, 10)])
def test_central_depth_rounds_half_to_even(spark, n, middle):
    rows = spark.createDataFrame([("a", i, float(i * i)) for i in range(1, n + 1)], "g string, i int, v double")
    used = range(1, n + 1) if middle is None else range(middle - 4, middle + 5)
    assert segments.central_depth(rows, ("g",), "i", "v").first()["depth"] == pytest.approx(np.mean([i * i for i in used]))


def brute_clusters(rows, within):
    """One pass over a chromosome in order, with what passed last."""
    out, last = [], None
    for pos, kind, found in rows:
        if kind == "SNV" and found == "PASS" and last is not None and pos - last < within:
            found = f"Cluster{within}bp"
            if out:
                out[-1] = found
        elif kind == "SNV" and found == "PASS":
            last = pos
        out.append(found)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_clusters_match_a_loop(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for name in "ab":
        places = sorted(rng.sample(range(120), 60))
        one = [(p, rng.choice(["SNV", "SNV", "SNV", "Deletion"]), rng.choice(["PASS", "PASS", "q22.5"])) for p in places]
        rows += [(name, *r) for r in one]
        want += brute_clusters(one, 3)
    got = variants.flag_clusters(spark.createDataFrame(rows, "chr string, pos long, type string, filter string"), 3).orderBy("chr", "pos").collect()
    assert [r["filter"] for r in got] == want


def test_clusters_count_from_what_passed_last(spark):
    rows = spark.createDataFrame([("a", p, "SNV", "PASS") for p in (0, 2, 4)], "chr string, pos long, type string, filter string")
    assert [r["filter"] for r in variants.flag_clusters(rows, 3).orderBy("pos").collect()] == ["Cluster3bp", "Cluster3bp", "PASS"]


def test_amplicons_and_odd_ratios(spark):
    base = {"dp": 90, "hicnt": 9, "hiaf": 0.2, "af": 0.3, "pmean": 20.0, "pstd": 0.0, "qual": 40.0, "mapq": 60.0, "sn": 9.0, "nm": 1.0, "msi": 1.0, "msilen": 3.0, "bias": "2;1", "sbf": 0.001, "oddratio": 1.0, "start": 1, "end": 2, "ref": "A", "alt": "C", "vd": 8, "gamp": 1, "tamp": 3, "ncamp": 0, "ampflag": None}
    cases = [{}, {"ampflag": "0"}, {"ampflag": "1", "gamp": 3}, {"oddratio": 0.1}, {"oddratio": math.inf}, {"oddratio": 0.0}]
    rows = spark.createDataFrame([tuple((base | c).values()) for c in cases], "dp int, hicnt int, hiaf double, af double, pmean double, pstd double, qual double, mapq double, sn double, nm double, msi double, msilen double, bias string, sbf double, oddratio double, start int, end int, ref string, alt string, vd int, gamp int, tamp int, ncamp int, ampflag string")
    assert [r["filter"] for r in variants.hard_filters(rows).collect()] == ["pSTD", "AMPBIAS", "AMPBIAS", "pSTD;Bias", "pSTD;Bias", "pSTD;Bias"]


def test_similarity_is_a_share_of_a_samples_weights(spark):
    r = spark.createDataFrame([("x", "x", 1.0), ("x", "y", 0.9), ("x", "z", 0.4)], "a string, b string, r double")
    cov = spark.createDataFrame([(s, "1", 0, 5.0) for s in "xyz"], "sample string, chr string, start long, cov double")
    got = {x["sample"]: x["weight"] for x in fit.similarity_weights(cov, r).collect()}
    total = 1 + 0.8**8
    assert got == {"x": round(1000 / total), "y": round(1000 * 0.8**8 / total)}


def test_outlier_regions_go_by_their_median(spark):
    rng = np.random.default_rng(12)
    rows = [(s, "1", i, i + 1, float(rng.negative_binomial(60, 60 / 160)) * (5 if i < 5 else 1)) for s in "abc" for i in range(200)]
    rows[150] = (*rows[150][:4], 900.0)  # one sample's height alone is no outlier of the region
    out = fit.outlier_regions(spark.createDataFrame(rows, "sample string, chr string, start long, end long, cov double"), "cov", 0.01)
    bad = {r["start"] for r in out.where("outlier").collect()}
    assert set(range(5)) <= bad and 150 not in bad and len(bad) < 20
    low, high = fit.nb_quantile(0.1, 60.0, 100.0), fit.nb_quantile(0.9, 60.0, 100.0)
    assert 0.7 <= sum(low < r[4] < high for r in rows[5:150]) / 145 <= 0.9 and fit.outlier_regions(out.drop("outlier"), "cov", 0).where("outlier").count() == 0


def test_histograms_are_bounded(spark):
    rows = spark.range(5000).select((F.col("id") * 3).alias("c"))
    assert fit.histogram(rows, "c", 100).count() <= 101 and fit.histogram(rows, "c", 100).agg(F.sum("n")).first()[0] == 5000
    assert fit.histogram(rows, "c").count() == 5000 and math.isnan(fit.trimmed_fit(rows.where("c < 0"), "c")[0])


def test_few_values_of_a_wide_range_are_exact(spark):
    """Neighbouring counts and one far above them, as deep coverage has, are not counted in steps."""
    rows = spark.range(3000).select(F.when(F.col("id") == 0, 5_000_000).otherwise(190_000 + F.col("id") % 1000).alias("c"))
    got = {r["value"]: r["n"] for r in fit.histogram(rows, "c").collect()}
    assert got == {5_000_000: 1, **{190_000 + i: 3 if i else 2 for i in range(1000)}}


def test_greedy_groups_and_axis_limits_hold_no_group_in_a_row(spark):
    regions = spark.createDataFrame([(c, s, s + 5) for c in "ab" for s in range(0, 300, 10)], "chr string, start long, end long")
    cn = [("x", round(2 + (i * 37 % 100) / 100, 2)) for i in range(200)] + [("x", None), ("y", 2.01), ("z", None)]
    limits = segments.axis_limits(spark.createDataFrame(cn, "contig string, cn double"))
    groups = intervals.greedy_groups(regions, 100)
    assert [(r["chr"], r["group"]) for r in groups.orderBy("chr", "start").collect()] == [(c, 1 + s // 100) for c in "ab" for s in range(0, 300, 10)]
    deviations = sorted(abs(v - 2) for c, v in cn if c == "x" and v is not None)
    assert {r["contig"]: r["axis_limit_0"] for r in limits.collect()} == {"x": math.ceil(deviations[197]), "y": 0, "z": 0}  # the 198th of 200
    for made in (groups, limits):
        assert "collect_list" not in made._jdf.queryExecution().toString()


def _one_table(a, b, c, d):
    """The test and the odds ratio of one table by the sums themselves and bisection."""
    row, column, total = a + b, a + c, a + b + c + d
    low, high = max(0, column - (total - row)), min(row, column)
    support = range(low, high + 1)
    ways = [math.comb(row, x) * math.comb(total - row, column - x) for x in support]
    seen = ways[a - low]
    p = sum(w for w in ways if w <= seen * (1 + 1e-7)) / sum(ways)
    if low == high:
        return p, math.nan
    if a in (low, high):
        return p, 0.0 if a == low else math.inf
    lo, hi = -60.0, 60.0
    for _ in range(120):
        t = (lo + hi) / 2
        top = max(math.log(k) + (x - a) * t for x, k in zip(support, ways))
        w = [math.exp(math.log(k) + (x - a) * t - top) for x, k in zip(support, ways)]
        lo, hi = (t, hi) if sum(x * y for x, y in zip(support, w)) < a * sum(w) else (lo, t)
    return p, math.exp((lo + hi) / 2)


def test_fisher_tables_at_once(monkeypatch):
    rng = random.Random(3)
    tables = [[rng.randrange(rng.choice([2, 9, 60])) for _ in range(4)] for _ in range(150)] + [[0, 0, 0, 0], [500, 3, 4, 700], [1, 900, 2, 5]]
    for cells in (1 << 20, 50):
        monkeypatch.setattr(fit, "SUPPORT_CELLS", cells)
        for t, p, odds in zip(tables, *fit.fisher_tables(np.array(tables))):
            want = _one_table(*t)
            assert p == pytest.approx(want[0], rel=1e-9) and odds == pytest.approx(want[1], rel=1e-8, nan_ok=True)
    assert fit.log_factorial(np.array([0, 1, 5, 8, 9, 100, 10**6])) == pytest.approx([math.lgamma(n + 1) for n in (0, 1, 5, 8, 9, 100, 10**6)], rel=1e-13)


def test_panel_products_on_a_grid_with_holes(spark, monkeypatch):
    """Against plain sums, in one block and in many, of one tile and of several; absent regions are 0."""
    rng = np.random.default_rng(8)
    base = rng.normal(100, 30, 40)
    full = {f"s{i}": base * (i % 3 != 2) + rng.normal(50, 12, 40) for i in range(6)}
    rows = [(s, f"c{k % 2}", k * 10, float(v)) for s, x in full.items() for k, v in enumerate(x) if rng.random() < 0.8] + [("flat", "c0", 0, 0.0), ("flat", "c1", 10, None)]
    df = spark.createDataFrame(rows, "sample string, chr string, start long, cov double")
    regions = sorted({(c, p) for _, c, p, _ in rows})
    names = sorted({r[0] for r in rows})
    at = {(s, c, p): v or 0.0 for s, c, p, v in rows}
    x = np.array([[at.get((s, *r), 0.0) for s in names] for r in regions])
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(x.T)
    for cells, tile in ((1 << 21, 1024), (25, 2), (7, 1)):
        monkeypatch.setattr(normalize, "BLOCK_CELLS", cells)
        monkeypatch.setattr(normalize, "TILE", tile)
        found = normalize.sample_correlation(df, 0.2)
        got = {(r["a"], r["b"]): (r["r"], r["weight"]) for r in found.collect()}
        assert len(got) == len(names) ** 2
        for i, a in enumerate(names):
            for j, b in enumerate(names):
                r, w = got[a, b]
                assert (r is None and math.isnan(want[i, j])) or r == pytest.approx(want[i, j], abs=1e-9)
                assert w == pytest.approx(1.0 if i == j else max(0.0, (0 if math.isnan(want[i, j]) else want[i, j] - 0.2) / 0.8), abs=1e-9)
        w = np.array([[got[a, b][1] for b in names] for a in names])
        rows_found = normalize.weighted_moments(df, found).collect()
        assert sorted((r["sample"], r["chr"], r["start"]) for r in rows_found) == sorted((s, *r) for s in names for r in regions)
        for r in rows_found:
            own, values = w[names.index(r["sample"])], x[regions.index((r["chr"], r["start"]))]
            mean, n = (own * values).sum() / own.sum(), (own > 0).sum()
            sd = math.sqrt((own * (values - mean) ** 2).sum() / ((n - 1) / n * own.sum())) if n > 1 else 1.0
            assert r["w_mean"] == pytest.approx(mean, abs=1e-8) and r["w_sd"] == pytest.approx(sd, abs=1e-5)


def test_axis_limits_by_hand(spark):
    """a: the 99th of 100 deviations; b: the first of two; c: one deviation is none; d: no copy numbers."""
    rows = [("a", 2 + (i if i % 2 else -i) / 4) for i in range(1, 101)] + [("b", 2.5), ("b", 40.0), ("b", None), ("c", 90.0), ("d", None)]
    found = segments.axis_limits(spark.createDataFrame(rows, "contig string, cn double"))
    assert {r["contig"]: (r["axis_limit_0"], r["axis_limit_15"]) for r in found.collect()} == {"a": (25, 25), "b": (1, 15), "c": (0, 15), "d": (0, 15)}
    assert segments.axis_limits(spark.createDataFrame([], "contig string, cn double"), (3,)).columns == ["contig", "axis_limit_3"]
