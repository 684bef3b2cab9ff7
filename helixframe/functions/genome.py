"""Column functions of the genomic domain."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, f) -> Column:
    """``f`` of a value that is evaluated once, however often ``f`` uses it: it is bound to a lambda's variable."""
    return F.element_at(F.transform(F.array(value), f), 1)


def chr_rank(name: Column) -> Column:
    """Natural order of chromosomes: names with a number and no underscore first, by the number, then X, Y, MT, then the rest by name."""
    bare = F.regexp_replace(name, "(?i)^chr", "")
    digits = F.regexp_replace(name, "[^0-9]", "")
    number = F.when(~name.contains("_") & digits.rlike("^[0-9]{1,9}$"), digits.cast("int"))
    return F.coalesce(number, F.when(bare == "X", 1_000_000_001).when(bare == "Y", 1_000_000_002).when(bare.isin("M", "MT"), 1_000_000_003), F.lit(1_000_000_004))


def bare_name(chromosome: Column) -> Column:
    """A chromosome's name without the prefix chr."""
    return F.regexp_replace(chromosome, "^chr", "")


def autosome(chromosome: Column, count: int = 22) -> Column:
    """Whether a chromosome is numbered from 1 to ``count``, with or without the prefix chr."""
    return bare_name(chromosome).isin(*[str(i) for i in range(1, count + 1)])


def gc_bin(gc: Column, width: float = 0.005) -> Column:
    """Right-closed bin number of a GC share in (0, 1], null outside."""
    return F.when((gc > 0) & (gc <= 1), F.ceil(F.round(gc / width, 9)))


def logistic(x: Column, middle: float, scale: float) -> Column:
    return 1 / (1 + F.exp(-(x - middle) / scale))


def lgamma(x: Column) -> Column:
    """log of the gamma function for x > 0: Stirling's series after a shift by eight."""

    def series(x: Column) -> Column:
        z = x + 8.0
        shift = F.ln(x * (x + 1) * (x + 2) * (x + 3)) + F.ln((x + 4) * (x + 5) * (x + 6) * (x + 7))
        inverse = 1 / (z * z)
        tail = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse * (1 / 1680 - inverse * (1 / 1188))))) / z
        return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + tail - shift

    return let(x.cast("double"), series)


def nb_log_pmf(k: Column, mean: Column, size: Column) -> Column:
    """log probability of a count under a negative binomial distribution."""
    return let(size, lambda r: let(mean, lambda m: lgamma(k + r) - lgamma(r) - lgamma(k + 1.0) + r * F.ln(r / (r + m)) + k * F.ln(m / (r + m))))


#: Abramowitz and Stegun 7.1.26, fixed values.
ERF = (0.3275911, 0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x: Column) -> Column:
    """Error function with an error below 1.5e-7."""
    p, a1, a2, a3, a4, a5 = ERF

    def value(x: Column) -> Column:
        y = F.abs(x)
        fit = let(1 / (1 + p * y), lambda t: 1 - t * (a1 + t * (a2 + t * (a3 + t * (a4 + t * a5)))) * F.exp(-y * y))
        return F.when(x < 0, -fit).otherwise(fit)

    return let(x, value)


def normal_two_sided(z: Column) -> Column:
    """Probability of a standard normal value at least as far from 0."""
    return 1 - erf(F.abs(z) / math.sqrt(2))


def log_choose(n: Column, k: Column) -> Column:
    return lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0)


def beta_log_density(x: Column, successes: Column, failures: Column) -> Column:
    """log density at x of Beta(successes + 1, failures + 1)."""
    n = successes + failures
    return F.ln(n + 1.0) + log_choose(n, successes) + successes * F.ln(x) + failures * F.ln(1 - x)


def beta_cdf(x: float, successes: Column, failures: Column) -> Column:
    """P(Beta(successes + 1, failures + 1) <= x) for whole numbers: P(Bin(n, x) > successes), n = successes + failures + 1.

    Terms are summed from the one nearest the mean outwards, each from the one before, on the side
    that holds less than about half; nine standard deviations and 40 terms are enough for any
    number of reads. By symmetry, 1 - beta_cdf(1 - x, a, b) is beta_cdf(x, b, a).
    """
    a, n = successes.cast("double"), (successes + failures + 1).cast("double")
    odds = x / (1 - x)

    def total(ends: Column) -> Column:
        a, n = ends["a"], ends["n"]
        above = a + 1 > n * x
        i = F.when(above, a + 1).otherwise(a)
        first = F.exp(log_choose(n, i) + i * math.log(x) + (n - i) * math.log(1 - x))
        steps = F.least(F.when(above, n - i).otherwise(i), 40 + 9 * F.sqrt(n * (x * (1 - x)))).cast("int")
        after = lambda i: F.when(above, (n - i) / (i + 1) * odds).otherwise(i / (n - i + 1) / odds)
        step = lambda acc, _: F.struct((acc["t"] * after(acc["i"])).alias("t"), (acc["s"] + acc["t"]).alias("s"), (acc["i"] + F.when(above, 1.0).otherwise(-1.0)).alias("i"))
        begin = F.struct(first.alias("t"), F.lit(0.0).alias("s"), i.alias("i"))
        return F.aggregate(F.sequence(F.lit(0), steps), begin, step, lambda acc: F.when(above, acc["s"]).otherwise(1 - acc["s"]))

    return let(F.struct(a.alias("a"), n.alias("n")), total)


#: Cost of what can't be.
WORST = 1000.0


def neg_log(p: Column) -> Column:
    """-ln(p), WORST where p is 0."""
    return F.when(p > 0, -F.ln(p)).otherwise(F.lit(WORST))
