"""Fits: negative binomial from a histogram, tumour purity from a mixture, strand bias, sample clusters."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


#: Distinct whole numbers that a histogram has at most; more of them are counted in equal steps of their range.
MOST_VALUES = 1 << 17


def histogram(counts: DataFrame, column: str, most: int = MOST_VALUES) -> DataFrame:
    """(value, n, part): how often each whole number occurs, at most ``most`` of them, and how often as part of a number above it.

    Numbers are cut off to whole ones, however wide their range. Only where more than ``most`` different
    ones occur, they are counted in steps, and a step's value is its mean.
    """
    known = counts.where(F.col(column).isNotNull())
    whole = known.select(F.col(column).cast("long").alias("value"), (F.col(column) > F.col(column).cast("long")).cast("long").alias("part"))
    each = whole.groupBy("value").agg(F.count("*").alias("n"), F.sum("part").alias("part"))
    ends = each.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("different")).first()
    if ends["different"] <= most:
        return each
    step = -(-(ends["high"] - ends["low"] + 1) // most)
    grouped = whole.groupBy(F.floor(F.col("value") / step).alias("at"))
    return grouped.agg(F.round(F.avg("value")).cast("long").alias("value"), F.count("*").alias("n"), F.sum("part").alias("part")).drop("at")


def _digamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    total = np.zeros_like(x)
    for _ in range(8):
        total -= 1 / x
        x = x + 1
    inverse = 1 / (x * x)
    return total + np.log(x) - 0.5 / x - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252))


def fit_nb(values: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(size, mean) of the likeliest negative binomial; size is infinite if the variance is no larger than the mean."""
    total = n.sum()
    mean = float((values * n).sum() / total)
    variance = float((n * (values - mean) ** 2).sum() / total)
    if variance <= mean or mean <= 0:
        return math.inf, mean

    def slope(log_size: float) -> float:
        r = math.exp(log_size)
        return float((n * (_digamma(values + r) - _digamma(np.array([r])) + math.log(r / (r + mean)))).sum())

    low, high = -12.0, 20.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    return math.exp((low + high) / 2), mean


def nb_log_probability(k: np.ndarray, size: float, mean: float) -> np.ndarray:
    lg = np.vectorize(math.lgamma)
    if math.isinf(size):
        return k * math.log(mean) - mean - lg(k + 1.0)
    return lg(k + size) - math.lgamma(size) - lg(k + 1.0) + size * math.log(size / (size + mean)) + k * math.log(mean / (size + mean))


def _fraction(value, least: float = 1e-300) -> float:
    """A continued fraction 1 / (1 + d1 / (1 + d2 / ...)) by Lentz's method; ``value(j)`` is dj."""
    # Of 1 + d1 / (1 + d2 / ...), which is then inverted.
    c, d, found = 1.0, 0.0, 1.0
    for j in range(1, 1_000_000):
        v = value(j)
        d = 1 / ((1 + v * d) or least)
        c = (1 + v / c) or least
        found *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return 1 / found if found else math.inf


#: From here on logarithms of gamma functions are taken together, by Stirling's series, as their difference is far smaller than they are.
LARGE = 1e5


def _log_gamma_ratio(a: float, b: float) -> float:
    """ln(gamma(a + b) / gamma(b))."""
    if b < LARGE:
        return math.lgamma(a + b) - math.lgamma(b)
    return (b - 0.5) * math.log1p(a / b) + a * math.log(a + b) - a + 1 / (12 * (a + b)) - 1 / (12 * b)


def beta_share(x: float, a: float, b: float, y: float | None = None) -> float:
    """The regularised incomplete beta function I_x(a, b); ``y`` is 1 - x, where it is known more closely."""
    y = 1 - x if y is None else y
    if x <= 0 or y <= 0:
        return float(y <= 0)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(y, b, a, x)

    def value(j: int) -> float:
        m = j // 2
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if j % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

    log_x, log_y = (math.log(v) if v < 0.5 else math.log1p(-w) for v, w in ((x, y), (y, x)))
    small, large = min(a, b), max(a, b)
    front = math.exp(a * log_x + b * log_y + _log_gamma_ratio(small, large) - math.lgamma(small)) / a
    return min(1.0, front * _fraction(value))


def gamma_rest(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    off = (x - a) / a
    front = math.exp(a * math.log(x) - x - math.lgamma(a) if a < LARGE else a * (math.log1p(off) - off) + 0.5 * math.log(a / (2 * math.pi)) - 1 / (12 * a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-17:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - front * total)
    # The even part of the fraction, from the back, with as many terms as it takes from the front.
    c, d, found = math.inf, 1 / (x + 1 - a), 1 / (x + 1 - a)
    for i in range(1, 1_000_000):
        n, step = -i * (i - a), x + 2 * i + 1 - a
        d, c = 1 / (n * d + step), step + n / c
        found *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * found


def nb_share(k: int, size: float, mean: float) -> float:
    """The probability of at most ``k``."""
    if k < 0:
        return 0.0
    if mean <= 0:
        return 1.0
    return gamma_rest(k + 1, mean) if math.isinf(size) else beta_share(size / (size + mean), size, k + 1, mean / (size + mean))


def nb_quantile(p: float, size: float, mean: float) -> int:
    """The smallest count whose cumulative probability is at least ``p``, of any size: by the incomplete beta (or gamma) function, between bounds that are halved."""
    low, high = -1, 1
    while nb_share(high, size, mean) < p:
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if nb_share(middle, size, mean) >= p else (middle, high)
    return high


def _columns(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A histogram's values, counts and counts of parts; its rows are bounded (MOST_VALUES)."""
    found = rows.toPandas().sort_values("value")
    return tuple(found[c].to_numpy(float) for c in ("value", "n", "part"))


def trimmed_fit(counts: DataFrame, column: str, p: float = 0.1, rounds: int = 6) -> tuple[float, float, int]:
    """(size, mean, rows used): the fit repeated without numbers outside the p and 1 - p quantiles, ends out.

    What is compared is the number itself, what is fitted its whole part. One aggregate over the data; the rounds work on its histogram of whole numbers. Without counts
    all is unknown (NaN, NaN, 0).
    """
    values, n, part = _columns(histogram(counts, column))
    if not len(values):
        return math.nan, math.nan, 0
    for _ in range(rounds):
        size, mean = fit_nb(values, n)
        low, high = nb_quantile(p, size, mean), nb_quantile(1 - p, size, mean)
        # Of the numbers with the lower end as their whole part, those above it are inside.
        inside = np.where(values == low, part, n)
        keep = (values >= low) & (values < high) & (inside > 0)
        if not keep.any():
            break
        values, n, part = values[keep], inside[keep], part[keep]
    size, mean = fit_nb(values, n)
    return size, mean, int(n.sum())


def outlier_regions(coverage: DataFrame, column: str, p: float, rounds: int = 2) -> DataFrame:
    """``outlier``: regions whose median over samples is outside the p and 1 - p quantiles of a fit, ends in; none for p of 0.

    The fit is repeated without the rows of the regions that are out, so what is in has a median
    between the closest limits so far.
    """
    if p <= 0:
        return coverage.withColumn("outlier", F.lit(False))
    keys = ["chr", "start", "end"]
    medians = coverage.groupBy(*keys).agg(F.median(column).alias("__median"))
    rows = coverage.join(medians, keys)
    low, high = -math.inf, math.inf
    for _ in range(rounds):
        values, n, _ = _columns(histogram(rows.where((F.col("__median") > low) & (F.col("__median") < high)), column))
        if not len(values):
            break
        size, mean = fit_nb(values, n)
        low, high = max(low, nb_quantile(p, size, mean)), min(high, nb_quantile(1 - p, size, mean))
    return rows.withColumn("outlier", ~((F.col("__median") > low) & (F.col("__median") < high))).drop("__median")


#: Counts of whole regions that are fitted together.
FIT_ROWS = 1 << 17


def fit_nb_groups(values: np.ndarray, n: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, means) of ``fit_nb`` of each group (0, 1, ...): the sizes of all groups are bracketed and halved together."""
    total = np.bincount(group, n)
    mean = np.bincount(group, values * n) / total
    variance = np.bincount(group, n * (values - mean[group]) ** 2) / total
    size = np.full(len(total), np.inf)
    going = np.flatnonzero((variance > mean) & (mean > 0))
    if not len(going):
        return size, mean
    place = np.full(len(total), -1)
    place[going] = np.arange(len(going))
    kept = place[group] >= 0
    values, n, group, level, total = values[kept], n[kept], place[group][kept], mean[going], total[going]
    low, high = np.full(len(going), -12.0), np.full(len(going), 20.0)
    for _ in range(60):  # 32 halved so often is beyond a double's digits
        middle = (low + high) / 2
        r = np.exp(middle)
        slope = np.bincount(group, n * _digamma(values + r[group])) + total * (np.log(r / (r + level)) - _digamma(r))
        low, high = np.where(slope > 0, middle, low), np.where(slope > 0, high, middle)
    size[going] = np.exp((low + high) / 2)
    return size, mean


def weighted_nb_fit(rows: DataFrame, by: tuple = ("chr", "start")) -> DataFrame:
    """(``by``, size, mean) of each region's counts (cov) with weights (weight).

    A task reads its regions in order and fits as many whole ones together as FIT_ROWS counts hold.
    """
    named = rows.select(*by, F.col("cov").cast("double").alias("cov"), F.col("weight").cast("double").alias("weight"))

    def fitted(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        group = np.zeros(table.num_rows, np.int64)
        group[first[1:]] = 1
        size, mean = fit_nb_groups(*(table.column(c).to_numpy() for c in ("cov", "weight")), np.cumsum(group))
        keys = table.select(list(by)).take(pa.array(first))
        return pa.RecordBatch.from_arrays([*(keys.column(c).combine_chunks() for c in by), pa.array(size), pa.array(mean)], names=[*by, "size", "mean"])

    def begins(table: pa.Table) -> np.ndarray:
        keys = list(zip(*(table.column(c).to_pylist() for c in by)))
        return np.array([i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]], np.int64)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < FIT_ROWS:
                continue
            table = pa.Table.from_batches(held)
            first = begins(table)
            if len(first) > 1:  # the last region may go on
                yield fitted(table.slice(0, int(first[-1])), first[:-1])
                table = table.slice(int(first[-1]))
            held, n = table.to_batches(), table.num_rows
        if n:
            table = pa.Table.from_batches(held)
            yield fitted(table, begins(table))

    schema = StructType([*[named.schema[c] for c in by], StructField("size", DoubleType()), StructField("mean", DoubleType())])
    return named.where("cov is not null and weight > 0").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def mixture(x: np.ndarray, n: np.ndarray | None = None, most: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, means, sds) of the Gaussian mixture of values ``x`` that occur ``n`` times with the best Bayesian information criterion.

    Each number of parts is tried with a deviation for each part and with one for all.
    """
    order = np.argsort(x, kind="stable")
    x, n = x[order], (np.ones(len(x)) if n is None else np.asarray(n, float)[order])
    total, until, best = n.sum(), np.cumsum(n), None
    centre = (x * n).sum() / total
    overall = math.sqrt((n * (x - centre) ** 2).sum() / total)
    for k in range(1, min(most, max(1, int(total) // 4), len(x)) + 1):
        for equal in (False, True) if k > 1 else (False,):
            mean = x[np.minimum(np.searchsorted(until, total * (np.arange(k) + 0.5) / k), len(x) - 1)]
            sd, weight = np.full(k, max(overall / k, 1e-6)), np.full(k, 1 / k)
            log_like = -np.inf
            for _ in range(200):
                log_p = np.log(weight) - np.log(sd) - 0.5 * ((x[:, None] - mean) / sd) ** 2 - 0.5 * np.log(2 * np.pi)
                top = log_p.max(1, keepdims=True)
                sums = top[:, 0] + np.log(np.exp(log_p - top).sum(1))
                share = np.exp(log_p - sums[:, None]) * n[:, None]
                size = share.sum(0) + 1e-9
                mean = (share * x[:, None]).sum(0) / size
                off = (share * (x[:, None] - mean) ** 2).sum(0)
                sd = np.maximum(np.sqrt(np.full(k, off.sum() / total) if equal else off / size), 1e-3 * (overall + 1e-9))
                weight = size / size.sum()
                now = float((n * sums).sum())
                if now - log_like < 1e-6 * abs(now):
                    break
                log_like = now
            bic = -2 * now + (2 * k if equal else 3 * k - 1) * math.log(total)
            if best is None or bic < best[0]:
                best = bic, weight, mean, sd
    return best[1:]


#: Steps between a sample's least and largest coverage in which it is counted for the mixture.
MIXTURE_STEPS = 4096


def purity_prior(coverage: DataFrame) -> DataFrame:
    """(sample, purity, score) from the peaks of a sample's coverage.

    Coverage is counted in MIXTURE_STEPS steps of its range, each with the mean of its values, so a
    sample is a few rows however many regions it has. The mode of a 200-bin histogram between half and
    twice the mean is the normal level n; purities TL from 0.02 to 1 are scored by each peak's distance
    to the levels TL * {1/2, 1, 3/2} * n + (1 - TL) * n. Peaks of the mixture count between 1/4 and 7/4 n
    if their weight is within a deviation of the mean weight; a sample without such peaks has no estimate.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, n = rows["x"].to_numpy(float), rows["n"].to_numpy(float)
        mean = (x * n).sum() / n.sum()
        inside = (x > mean / 2) & (x < 2 * mean)
        inside = inside if inside.any() else np.ones(len(x), bool)
        count, edge = np.histogram(x[inside], 200, weights=n[inside])
        normal = (edge[count.argmax()] + edge[count.argmax() + 1]) / 2
        weight, peak, _ = mixture(x, n)
        spread = weight.std(ddof=1) if len(weight) > 1 else np.nan
        usual = np.abs(weight - weight.mean()) < spread
        peak = peak[(peak > 0.25 * normal) & (peak < 1.75 * normal) & usual]
        grid = np.round(np.arange(0.02, 1.001, 0.01), 2)
        levels = grid[:, None] * np.array([0.5, 1.0, 1.5]) * normal + (1 - grid[:, None]) * normal
        score = np.abs(levels[:, :, None] - peak).min(1).sum(1) if len(peak) else np.zeros(len(grid))
        at = int(score.argmin())
        return pd.DataFrame({"sample": rows["sample"].iloc[:1], "purity": [grid[at] if len(peak) else np.nan], "score": [score[at]]})

    known = coverage.where("cov is not null").select("sample", F.col("cov").cast("double").alias("cov"))
    ends = known.groupBy("sample").agg(F.min("cov").alias("low"), F.max("cov").alias("high"))
    step = F.floor(F.coalesce(F.try_divide(F.col("cov") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0)) * MIXTURE_STEPS)
    counted = known.join(ends, "sample").groupBy("sample", step.alias("step")).agg(F.avg("cov").alias("x"), F.count("*").alias("n"))
    return counted.groupBy("sample").applyInPandas(run, "sample string, purity double, score double")


def log_factorial(n: np.ndarray) -> np.ndarray:
    """ln n! of whole numbers, by Stirling's series from 9 on and the product below."""
    n = np.asarray(n, float)
    small = n < 9
    x = np.where(small, 9.0, n) + 1
    i = 1 / (x * x)
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - i * (1 / 360 - i * (1 / 1260 - i * (1 / 1680 - i / 1188)))) / x
    return np.where(small, np.log([math.factorial(k) for k in range(9)])[np.where(small, n, 0).astype(int)], series)


#: Cells of the supports that are looked at together.
SUPPORT_CELLS = 1 << 20


def fisher_tables(tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(p, odds ratio) of the 2 x 2 tables in the rows (a, b, c, d): two-sided p and the conditional likeliest odds ratio.

    Tables of similar supports are taken together: their log-hypergeometric weights stand in one
    padded matrix, and the log odds ratio at which the expected a is the seen one is found for all of
    them by Newton steps, which halve the interval instead where they would leave it.
    """
    t = np.asarray(tables, np.int64).reshape(-1, 4)
    a, row, column, total = t[:, 0], t[:, 0] + t[:, 1], t[:, 0] + t[:, 2], t.sum(1)
    low, high = np.maximum(0, column - (total - row)), np.minimum(row, column)
    p, odds = np.ones(len(t)), np.full(len(t), np.nan)
    order, at = np.argsort(high - low, kind="stable"), 0
    while at < len(order):
        # Supports ascend, so the last one of a part is its widest.
        cells = np.arange(1, len(order) - at + 1) * (high - low + 1)[order[at:]]
        part = order[at : at + max(1, int(np.searchsorted(cells, SUPPORT_CELLS, "right")))]
        at += len(part)
        p[part], odds[part] = _tested(a[part], row[part], column[part], total[part], low[part], high[part])
    return p, odds


def fisher_exact(a: int, b: int, c: int, d: int) -> tuple[float, float]:
    """(p, odds ratio) of one table."""
    p, odds = fisher_tables(np.array([[a, b, c, d]]))
    return float(p[0]), float(odds[0])


def _tested(a, row, column, total, low, high) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(int((high - low).max()) + 1)
    x = low[:, None] + step
    inside = x <= high[:, None]
    x = np.where(inside, x, low[:, None])
    log_h = -sum(log_factorial(v) for v in (x, row[:, None] - x, column[:, None] - x, (total - row - column)[:, None] + x))
    log_h = np.where(inside, log_h, -np.inf)
    log_h -= log_h.max(1, keepdims=True)
    h = np.exp(log_h)
    h /= h.sum(1, keepdims=True)
    seen = h[np.arange(len(a)), a - low]
    p = np.minimum(1.0, np.where(h <= seen[:, None] * (1 + 1e-7), h, 0).sum(1))
    odds = np.where(low == high, np.nan, np.where(a == low, 0.0, np.inf))
    open_ = np.flatnonzero((a > low) & (a < high))
    if len(open_):
        odds[open_] = np.exp(_log_odds((a - low)[open_], log_h[open_], step))
    return p, odds


def _log_odds(seen: np.ndarray, log_h: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Where the mean of ``step`` under weights exp(log_h + t step) is ``seen``."""
    lo, hi, t = np.full(len(seen), -60.0), np.full(len(seen), 60.0), np.zeros(len(seen))
    going = np.arange(len(seen))
    for _ in range(200):
        w = log_h[going] + t[going, None] * step
        w = np.exp(w - w.max(1, keepdims=True))
        w /= w.sum(1, keepdims=True)
        mean = w @ step
        spread = w @ (step * step) - mean * mean
        off = mean - seen[going]
        lo[going], hi[going] = np.where(off < 0, t[going], lo[going]), np.where(off < 0, hi[going], t[going])
        with np.errstate(divide="ignore", invalid="ignore"):
            newton = t[going] - off / spread
        fits = (newton > lo[going]) & (newton < hi[going])
        after = np.where(fits, newton, (lo[going] + hi[going]) / 2)
        moved = np.abs(after - t[going])
        t[going] = after
        going = going[moved > 1e-13 * np.maximum(1, np.abs(after))]
        if not len(going):
            break
    return t


def strand_bias(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, p, odds_ratio) of the strand counts rfwd, rrev, vfwd, vrev, both to 5 decimals; tables that repeat are tested once, rows that lack a count are left out."""
    names = ["rfwd", "rrev", "vfwd", "vrev"]
    tables = rows.select(*[F.col(c).cast("long").alias(c) for c in names]).dropna().distinct()

    def run(batches):
        for t in batches:
            p, odds = fisher_tables(t[names].to_numpy())
            yield t.assign(p=np.round(p, 5), odds_ratio=np.where(np.isfinite(odds), np.round(odds, 5), odds))

    tested = tables.mapInPandas(run, "rfwd long, rrev long, vfwd long, vrev long, p double, odds_ratio double")
    return rows.select(id_col, *names).join(tested, names)


def sample_clusters(correlation: DataFrame, cut: float = 0.90) -> dict[str, int]:
    """Clusters of complete linkage on correlations above ``cut``, numbered by their first sample.

    The samples' matrix of distances comes to the driver as numbers, a row of Arrow for each pair and 8
    bytes a pair (200 MB for 5,000 samples); chains of nearest neighbours then merge in time that grows
    with its size. A pair without a correlation counts as -1. Equal distances go to the first pair.
    """
    table = correlation.select("a", "b", F.coalesce("r", F.lit(-1.0)).cast("double").alias("r")).toPandas()
    names = sorted(set(table["a"]))
    at = {n: i for i, n in enumerate(names)}
    far = np.full((len(names), len(names)), 2.0)
    far[table["a"].map(at).to_numpy(int), table["b"].map(at).to_numpy(int)] = 1 - table["r"].to_numpy()
    far = np.maximum(far, far.T)
    return dict(zip(names, complete_linkage(far, 1 - cut).tolist()))


def complete_linkage(far: np.ndarray, cut: float) -> np.ndarray:
    """The cluster of each row of a symmetric matrix of distances, merging while the farthest members are within ``cut``.

    A chain goes from a cluster to its nearest one until two are nearest to each other, which are
    merged; complete linkage never brings a merged pair nearer to others, so the order doesn't matter.
    """
    far = far.copy()
    np.fill_diagonal(far, np.inf)
    n = len(far)
    group, alive, chain, start = np.arange(n), np.ones(n, bool), [], 0
    while True:
        if not chain:
            while start < n and not alive[start]:
                start += 1
            if start == n:
                break
            chain = [start]
        at = chain[-1]
        near = int(far[at].argmin())
        if len(chain) > 1 and far[at, chain[-2]] <= far[at, near]:
            near = chain[-2]
        if not far[at, near] <= cut:
            # Nothing is near enough to the chain's end, nor will be: it is done.
            alive[at] = False
            far[at] = far[:, at] = np.inf
            chain.pop()
            continue
        if len(chain) > 1 and near == chain[-2]:
            kept, gone = min(at, near), max(at, near)
            joined = np.maximum(far[kept], far[gone])
            joined[kept] = np.inf
            far[kept] = far[:, kept] = joined
            far[gone] = far[:, gone] = np.inf
            alive[gone] = False
            group[group == gone] = kept
            chain = chain[:-2]
        else:
            chain.append(near)
    return np.unique(group, return_inverse=True)[1]


def similarity_weights(coverage: DataFrame, correlation: DataFrame, power: int = 8, scale: int = 1000) -> DataFrame:
    """Coverage of all samples with whole-number weights of their similarity to a target sample.

    A weight is (2 (r - 1/2)) to the ``power``, none below r = 1/2, as a share of the target's
    weights, in ``scale`` parts. Rows of no weight are left out; the join goes by sample, and Spark
    broadcasts the weights only if their size allows it.
    """
    raw = F.pow(F.greatest(2 * (F.col("r") - 0.5), F.lit(0.0)), F.lit(float(power)))
    raised = correlation.select(F.col("a").alias("target"), F.col("b").alias("sample"), F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.coalesce(raw, F.lit(0.0))).alias("w"))
    share = F.bround(F.col("w") / F.sum("w").over(Window.partitionBy("target")) * scale)
    w = raised.withColumn("weight", share).drop("w").where("weight > 0")
    return coverage.join(w, "sample").withColumn("n", F.count("*").over(Window.partitionBy("target", "chr", "start")))
