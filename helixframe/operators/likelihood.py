"""Likelihoods of the copy-number states from coverage and from allele counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.genome import beta_cdf, let, nb_log_pmf, neg_log, normal_two_sided
from helixframe.functions.model import COPIES, GENOTYPES, STATES, false_positive


def _normalised(values: Column) -> Column:
    """An array over its sum; unknown entries are 0."""
    clean = F.transform(values, lambda x: F.coalesce(F.when(F.isnan(x), 0.0).otherwise(x), F.lit(0.0)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    return let(clean, lambda c: let(total(c), lambda t: F.transform(c, lambda x: F.coalesce(F.try_divide(x, t), F.lit(0.0)))))


def state_costs(values: Column, floor: float | None = None, bonus: Column | None = None) -> Column:
    """Likelihoods of the states to costs: normalise, add ``bonus`` and the false-positive floor, normalise, -log."""
    floor = false_positive() if floor is None else floor
    shares = _normalised(values)
    if bonus is not None:
        shares = F.zip_with(shares, bonus, lambda x, more: x + more)
    return F.transform(_normalised(F.transform(shares, lambda x: x + floor)), neg_log)


#: What the state of most copies gets above the level of its copies, so that it wins where no state explains a depth.
TOP_STATE = 1e-10


def nb_coverage(coverage: DataFrame, mean: Column, variance: Column, load: float | Column = 1.0, states: tuple = STATES) -> DataFrame:
    """``nll``: costs of the states, coverage being negative binomial with mean and variance scaled by copies.

    Above the level of the most copies, their state gets TOP_STATE more.
    """
    load = load if isinstance(load, Column) else F.lit(float(load))
    copies = F.array(*[F.lit(COPIES[s] / 2) for s in states])

    def density(half: Column) -> Column:
        share = load * half + (1 - load)
        # No copies in a pure sample: a low mean of its own.
        mu, var = F.when(share > 0, mean * share).otherwise(1.0), F.when(share > 0, variance * share).otherwise(50.0)
        size = lambda m: let(var, lambda v: m * m / F.greatest(v - m, 1e-6 * m))
        return let(mu, lambda m: F.exp(nb_log_pmf(F.bround("cov").cast("double"), m, size(m))))

    top = max(states, key=COPIES.get)
    over = F.col("cov") > mean * (COPIES[top] / 2)
    bonus = F.array(*[F.when(over, F.lit(TOP_STATE)).otherwise(0.0) if s == top else F.lit(0.0) for s in states])
    return coverage.withColumn("nll", state_costs(F.transform(copies, density), bonus=bonus))


def normal_coverage(coverage: DataFrame, mean: Column, sd: Column, load: float | Column = 1.0, states: tuple = STATES) -> DataFrame:
    """``nll``: the same for a normal distribution, by the two-sided tail; a deviation of 0 tells no state from another."""
    load = load if isinstance(load, Column) else F.lit(float(load))
    shares = F.array(*[load * (COPIES[s] / 2) + (1 - load) for s in states])
    return coverage.withColumn("nll", state_costs(F.transform(shares, lambda share: normal_two_sided(F.try_divide(F.col("cov") - mean * share, sd)))))


#: Stands for the logarithm of 0 times a count.
NEVER = -1e9


def _log_share(count: Column, share: Column) -> Column:
    """count * ln(share), with 0 * ln(0) = 0; null without a share."""
    return F.when(share.isNotNull(), F.when(count == 0, 0.0).when(share > 0, count * F.ln(share)).otherwise(NEVER))


def homozygote_tails(sites: DataFrame) -> DataFrame:
    """(alt_count, ref_count, hom): how well a homozygous site explains each distinct pair of counts."""
    pairs = sites.select("alt_count", "ref_count").distinct()
    tail = F.greatest(beta_cdf(0.1, F.col("alt_count"), F.col("ref_count")), beta_cdf(0.1, F.col("ref_count"), F.col("alt_count")))
    return pairs.withColumn("hom", tail)


def _shares(df: DataFrame, values: list[Column], name: str) -> DataFrame:
    """Columns ``name``0, ...: values over their sum; unknown ones are 0. Plain columns, so Spark compiles them."""
    n = range(len(values))
    clean = df.withColumns({f"__v{i}": F.coalesce(F.when(F.isnan(v), 0.0).otherwise(v), F.lit(0.0)) for i, v in enumerate(values)})
    total = clean.withColumn("__sum", sum((F.col(f"__v{i}") for i in n), F.lit(0.0)))
    return total.withColumns({f"{name}{i}": F.coalesce(F.try_divide(f"__v{i}", "__sum"), F.lit(0.0)) for i in n}).drop("__sum", *[f"__v{i}" for i in n])


def snp_states(snps: DataFrame, load: float | str = 1.0, tails: DataFrame | None = None) -> DataFrame:
    """``nll``: costs of the states for a SNP with alt_count, ref_count and the heterozygote share pop_het.

    Each genotype expects an alternative share; a state is as likely as its likeliest genotype, mixed
    with the chance that the site is homozygous. Likelihoods are sums of logarithms less the
    largest, so deep sites tell states apart. In a sample that is all tumour, the state without
    copies has no expectation and gets the share 1/K. ``load`` is the tumour's share or a column's
    name. Counts repeat far more often than not, so each distinct (load, alt_count, ref_count) is
    scored once; ``tails`` are those of ``homozygote_tails``, where they are known.
    """
    given = snps if isinstance(load, str) else snps.withColumn("__load", F.lit(float(load)))
    keys = [load if isinstance(load, str) else "__load", "alt_count", "ref_count"]
    tl, alt, ref = F.col(keys[0]), F.col("alt_count").cast("double"), F.col("ref_count").cast("double")
    states = range(len(STATES))
    tables = given.select(*keys).distinct()
    expected = tables.withColumns({f"__e{g}": F.try_divide((1 - tl) + tl * variant, 2 * (1 - tl) + tl * copies) for g, (_, copies, variant, _) in enumerate(GENOTYPES)})
    # The binomial coefficient is the same for all genotypes and leaves with the normalisation.
    score = lambda g: math.log(GENOTYPES[g][3]) + _log_share(alt, F.col(f"__e{g}")) + _log_share(ref, 1 - F.col(f"__e{g}"))
    of = [[g for g, row in enumerate(GENOTYPES) if row[0] == s] for s in STATES]
    best = expected.withColumns({f"__s{i}": F.greatest(*map(score, own)) if len(own) > 1 else score(own[0]) for i, own in enumerate(of)})
    top = best.withColumn("__top", F.greatest(*[f"__s{i}" for i in states]))
    floor = false_positive()
    likely = _shares(top, [F.exp(F.col(f"__s{i}") - F.col("__top")) for i in states], "__q")
    raised = _shares(likely, [F.when(F.col(f"__s{i}").isNotNull(), F.col(f"__q{i}") + floor) for i in states], "__r")
    shown = raised.select(*keys, *[F.when(F.col(f"__s{i}").isNotNull(), F.col(f"__r{i}")).alias(f"__l{i}") for i in states])
    known = homozygote_tails(tables) if tails is None else tails
    scored = shown.join(known.withColumnRenamed("hom", "__hom"), ["alt_count", "ref_count"])
    mixed = _shares(given.join(scored, keys), [F.col("pop_het") * F.col(f"__l{i}") + (1 - F.col("pop_het")) * F.col("__hom") for i in states], "__p")
    k = len(STATES)
    final = [F.when(tl == 1.0, F.lit(1 / k) if i == 0 else F.col(f"__p{i}") * (1 - 1 / k)).otherwise(F.col(f"__p{i}")) for i in states]
    return mixed.withColumn("nll", F.array(*map(neg_log, final))).drop("__load", "__hom", *[f"__{c}{i}" for c in "lp" for i in states])


def add_site_costs(covered: DataFrame, sites: DataFrame, by: tuple = ("sample", "chr", "start", "end")) -> DataFrame:
    """``covered`` with the costs of each region's sites added to ``nll``: one sum for each state, made where the sites' rows are first."""
    k = len(STATES)
    sums = sites.groupBy(*by).agg(*[F.sum(F.get("nll", F.lit(i))).alias(f"__s{i}") for i in range(k)])
    both = F.array(*[F.get("nll", F.lit(i)) + F.coalesce(f"__s{i}", F.lit(0.0)) for i in range(k)])
    return covered.join(sums, list(by), "left").withColumn("nll", both).drop(*[f"__s{i}" for i in range(k)])


def combine(*parts: DataFrame, by: tuple = ("sample", "chr", "start", "end")) -> DataFrame:
    """(…, state, nll): costs of all evidence of a region, summed by state."""
    long = [p.select(*by, F.posexplode("nll").alias("state", "cost")) for p in parts]
    every = long[0]
    for more in long[1:]:
        every = every.unionByName(more)
    return every.groupBy(*by, "state").agg(F.sum("cost").alias("nll"))


def as_arrays(long: DataFrame, by: tuple = ("sample", "chr", "start", "end")) -> DataFrame:
    """The long form back to an array of costs in the states' order."""
    return long.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("state", "nll"))), lambda x: x["nll"]).alias("nll"))


def probability_profile(likelihoods: DataFrame) -> DataFrame:
    """(chr, start, state, share): mean probability of each state over samples, normalised by region."""
    long = likelihoods.select("chr", "start", F.posexplode("nll").alias("state", "cost"))
    mean = long.groupBy("chr", "start", "state").agg(F.avg(F.exp(-F.col("cost"))).alias("p"))
    return mean.withColumn("share", F.col("p") / F.sum("p").over(Window.partitionBy("chr", "start"))).drop("p")


def nb_copy_states(coverage: DataFrame, mean: Column, size: Column, copies: int = 5) -> DataFrame:
    """``probabilities`` of 0 to copies - 1 copies: mean scaled by c / 2 and size by (c / 2) squared, normalised.

    No copies have a mean of 1 and a size of 0.1.
    """
    k = F.bround("cov").cast("double")
    some = F.transform(F.array(*[F.lit(c / 2) for c in range(1, copies)]), lambda h: F.exp(nb_log_pmf(k, mean * h, size * h * h)))
    return coverage.withColumn("probabilities", _normalised(F.concat(F.array(F.exp(nb_log_pmf(k, F.lit(1.0), F.lit(0.1)))), some)))


def path_cost(likelihoods: DataFrame) -> DataFrame:
    """(sample, cost): the decoder's cost alone, summed over a sample's chromosomes."""
    from .hmm import path_costs

    return path_costs(likelihoods).groupBy("sample").agg(F.sum("chr_cost").alias("cost"))
