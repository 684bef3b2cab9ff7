"""Normalisation of coverage: library size, GC content, similar samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.genome import gc_bin


def library_size(coverage: DataFrame, cohort: DataFrame | None = None) -> DataFrame:
    """``cov``: raw coverage over its sample's mean, times the overall mean, or that of ``cov`` of an earlier ``cohort``.

    Means come from one row for each sample, so the overall mean needs no scan of its own.
    """
    sums = coverage.groupBy("sample").agg(F.sum("cov_raw").alias("total"), F.count("cov_raw").alias("n"))
    overall = (sums.agg((F.sum("total") / F.sum("n")).alias("overall_mean")) if cohort is None else cohort.agg(F.avg("cov").alias("overall_mean")))
    means = sums.select("sample", F.try_divide("total", "n").alias("sample_mean"))
    scaled = coverage.join(means, "sample").join(F.broadcast(overall))
    return scaled.withColumn("cov", F.try_divide(F.col("cov_raw"), F.col("sample_mean")) * F.col("overall_mean")).drop("sample_mean", "overall_mean")


def gc_content(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, gc, usable): share of G and C among all characters, and of A, C, G, T; gc is -1 where none is."""
    low = F.lower(F.col(text_col))
    share = lambda letters: F.try_divide(F.length(F.regexp_replace(low, f"[^{letters}]", "")).cast("double"), F.length(low).cast("double"))
    usable = F.coalesce(F.round(share("gcat"), 5), F.lit(0.0))
    return texts.select(id_col, F.when(usable == 0, -1.0).otherwise(share("gc")).alias("gc"), usable.alias("usable"))


def gc_regression(coverage: DataFrame) -> DataFrame:
    """``cov_norm``: coverage over its sample's linear fit on gc, times the mean of all samples."""
    fit = coverage.groupBy("sample").agg(F.regr_slope("cov", "gc").alias("slope"), F.regr_intercept("cov", "gc").alias("intercept"))
    overall = coverage.agg(F.avg("cov").alias("mean_cov"))
    fitted = coverage.join(fit, "sample").join(F.broadcast(overall))
    return fitted.withColumn("cov_norm", F.try_divide(F.col("cov"), F.col("slope") * F.col("gc") + F.col("intercept")) * F.col("mean_cov")).drop("mean_cov")


def gc_outliers(coverage: DataFrame, deviations: float = 4.0, most: int = 15, spread: float = 2.0, complete: float = 0.9, compat: bool = False) -> DataFrame:
    """Regions that are usable in enough samples: (chr, start, end, n_ok).

    In a sample, a region is fine if its GC bin has under ``most`` values above mean +
    ``deviations`` sd, or if the region itself is below mean + ``spread`` sd. Regions that are fine
    in more than ``complete`` of the samples stay; with ``compat`` every row counts as fine.
    """
    own = Window.partitionBy("sample")
    scored = coverage.withColumn("m", F.avg("cov_norm").over(own)).withColumn("s", F.stddev_samp("cov_norm").over(own)).withColumn("gc_bin", gc_bin(F.col("gc")))
    high = F.sum((F.col("cov_norm") > F.col("m") + deviations * F.col("s")).cast("int")).over(Window.partitionBy("sample", "gc_bin"))
    fine = (F.col("n_high") < most) | (F.col("cov_norm") < F.col("m") + spread * F.col("s"))
    marked = scored.withColumn("n_high", high).withColumn("ok", F.lit(True) if compat else fine)
    samples = coverage.agg(F.count_distinct("sample").alias("n_samples"))
    counted = marked.groupBy("chr", "start", "end").agg(F.count_if("ok").alias("n_ok"))
    return counted.join(F.broadcast(samples)).where(F.col("n_ok") > complete * F.col("n_samples")).drop("n_samples")


#: Cells of a block of regions and samples, and samples of a tile of a product.
BLOCK_CELLS = 1 << 21
TILE = 1024


def _cells(coverage: DataFrame) -> tuple[DataFrame, int, int, int]:
    """(cells (sample, chr, start, x, block), regions, blocks, tiles): regions are dealt to blocks by a hash, so blocks have about BLOCK_CELLS cells."""
    rows = coverage.select("sample", "chr", "start", F.coalesce(F.col("cov").cast("double"), F.lit(0.0)).alias("x"))
    n = rows.agg(F.count_distinct("sample").alias("samples"), F.count_distinct(F.struct("chr", "start")).alias("regions")).first()
    blocks = max(1, -(-n["samples"] * n["regions"] // BLOCK_CELLS))
    block = F.pmod(F.xxhash64("chr", "start"), F.lit(blocks)).cast("int")
    return rows.withColumn("block", block), n["regions"], blocks, max(1, -(-n["samples"] // TILE))


def _tile(sample: str, tiles: int):
    return F.pmod(F.xxhash64(sample), F.lit(tiles)).cast("int")


def _dense(cells: pa.Table) -> tuple[np.ndarray, list, pd.DataFrame]:
    """(matrix of regions and samples, samples, regions (chr, start)) of the cells of a block; what a sample lacks is 0, what it has twice is summed."""
    rows = cells.select(["sample", "chr", "start", "x"]).to_pandas()
    sample, names = pd.factorize(rows["sample"])
    region = rows.groupby(["chr", "start"], sort=False, dropna=False).ngroup().to_numpy()
    x = np.zeros((region.max(initial=-1) + 1, len(names)))
    np.add.at(x, (region, sample), rows["x"].to_numpy())
    places = rows[["chr", "start"]].iloc[np.unique(region, return_index=True)[1]]
    return x, list(names), places


def _gram(cells: pa.Table) -> pa.Table:
    """(a, b, xy): products of the columns of a block, of samples of one tile and the other, a first by name."""
    x, names, _ = _dense(cells)
    of = dict(zip(cells.column("sample").to_pylist(), cells.column("tile").to_pylist())) if cells.num_rows else {}
    low, high = cells.column("i")[0].as_py(), cells.column("j")[0].as_py()
    one, two = ([k for k, n in enumerate(names) if of[n] == t] for t in (low, high))
    xy = x[:, one].T @ x[:, two]
    keep = np.array([[names[p] <= names[q] or low != high for q in two] for p in one], bool).reshape(xy.shape)
    row, column = np.nonzero(keep)
    labels = pa.array(names, pa.string())
    return pa.table({"a": labels.take(pa.array(np.array(one, np.int64)[row])), "b": labels.take(pa.array(np.array(two, np.int64)[column])), "xy": pa.array(xy[row, column])})


def sample_correlation(coverage: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(a, b, r, weight): correlation of each pair of samples over regions, and max(0, r - threshold) rescaled; 1 for a sample and itself.

    A region that a sample lacks counts as 0 there; r is null where a sample does not vary. Cells are
    dealt to blocks of regions and pairs of sample tiles; each block gives its part of the products of
    all pairs by one matrix product, and the parts are summed by pair. With up to TILE samples every
    cell is shuffled once.
    """
    cells, regions, _, tiles = _cells(coverage)
    placed = cells.withColumn("tile", _tile("sample", tiles)).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    placed = placed.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).drop("other")
    parts = placed.groupBy("block", "i", "j").applyInArrow(_gram, "a string, b string, xy double")
    sums = parts.groupBy("a", "b").agg(F.sum("xy").alias("xy"))
    one = cells.groupBy("sample").agg(F.sum("x").alias("s")).join(sums.where("a = b").select(F.col("a").alias("sample"), F.col("xy").alias("xx")), "sample")
    spread = F.col("xx") - F.col("s") * F.col("s") / regions
    one = one.select("sample", "s", F.when(spread > 1e-12 * F.col("xx"), F.sqrt(spread)).alias("spread"))
    side = lambda name: one.select(F.col("sample").alias(name), F.col("s").alias(f"s_{name}"), F.col("spread").alias(f"spread_{name}"))
    r = F.when(F.col("a") == F.col("b"), F.when(F.col("spread_a").isNotNull(), 1.0)).otherwise((F.col("xy") - F.col("s_a") * F.col("s_b") / regions) / (F.col("spread_a") * F.col("spread_b")))
    found = sums.join(side("a"), "a").join(side("b"), "b").select("a", "b", r.alias("r"))
    both = found.select("r", F.inline(F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))))
    weight = F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.greatest(F.lit(0.0), F.coalesce((F.col("r") - threshold) / (1 - threshold), F.lit(0.0))))
    return both.select("a", "b", "r", weight.alias("weight"))


def norm_weights(weights: DataFrame) -> DataFrame:
    """(sample, norm_weight): the sum of a sample's weights over all samples, itself included."""
    return weights.groupBy(F.col("a").alias("sample")).agg(F.sum("weight").alias("norm_weight"))


def _moments(cells: pa.Table, weights: pa.Table) -> pa.Table:
    """(sample, chr, start, w_mean, w_sd) of a block's regions for a tile's samples, by products of the block and the weights."""
    x, names, places = _dense(cells)
    w = weights.select(["a", "b", "weight"]).to_pandas()
    at = {n: k for k, n in enumerate(names)}
    target, targets = pd.factorize(w["a"])
    known = np.array([at.get(b, len(names)) for b in w["b"]], np.int64)
    x = np.concatenate([x, np.zeros((len(x), 1))], 1)  # samples without a cell in the block: of weights that add no product
    by = np.zeros((x.shape[1], len(targets)))
    np.add.at(by, (known, target), w["weight"].to_numpy())
    n, total = np.bincount(target, minlength=len(targets)), by.sum(0)
    # Around each region's mean, so that little cancels.
    centre = x[:, :-1].sum(1, keepdims=True) / max(1, len(names))
    around = x - centre
    mean = around @ by / total
    with np.errstate(divide="ignore", invalid="ignore"):
        sd = np.sqrt(np.maximum(0, (around * around) @ by - mean * mean * total) / ((n - 1) / n * total))
    sd = np.where(np.isfinite(sd), sd, 1.0)
    row = np.repeat(np.arange(len(x)), len(targets))
    label = pa.array(targets, pa.string()).take(pa.array(np.tile(np.arange(len(targets)), len(x))))
    at_region = [pa.array(places[c].tolist(), cells.schema.field(c).type).take(pa.array(row)) for c in ("chr", "start")]
    return pa.table([label, *at_region, pa.array((mean + centre).ravel()), pa.array(sd.ravel())], names=["sample", "chr", "start", "w_mean", "w_sd"])


def weighted_moments(coverage: DataFrame, weights: DataFrame) -> DataFrame:
    """(sample, chr, start, w_mean, w_sd) of every sample and region over similar samples; an undefined deviation, of one sample alone, is 1.

    A region that a sample lacks counts as 0 there. Each block of regions meets the weights of a tile
    of samples in two matrix products; the weights travel once to each block.
    """
    cells, _, blocks, tiles = _cells(coverage)
    start = coverage.schema["start"].dataType.simpleString()
    known = weights.where("weight > 0").select("a", "b", "weight", _tile("a", tiles).alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    met = cells.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    return met.groupBy("block", "tile").cogroup(known.groupBy("block", "tile")).applyInArrow(_moments, f"sample string, chr string, start {start}, w_mean double, w_sd double")
