"""Runs of equal states along chromosomes, their rollups, and what is computed from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def along():
    """The regions of a sample's chromosome in order."""
    return Window.partitionBy("sample", "chr").orderBy("start")


def run_lengths(calls: DataFrame) -> DataFrame:
    """``cn_id``: ordinal of the run of equal cn_pred along a sample's chromosome."""
    changed = F.coalesce((F.col("cn_pred") != F.lag("cn_pred").over(along())).cast("int"), F.lit(1))
    return calls.withColumn("__new", changed).withColumn("cn_id", F.sum("__new").over(along()).cast("long")).drop("__new")


def distance_breaks(calls: DataFrame, most: int = 200_000) -> DataFrame:
    """``join_region_id``: grows after each region that is more than ``most`` before the next one."""
    gap = F.lead("start").over(along()) - F.col("end")
    flagged = calls.withColumn("__break", (F.coalesce(gap, F.lit(0)) > most).cast("int"))
    return flagged.withColumn("join_region_id", (1 + F.coalesce(F.sum("__break").over(along().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).cast("long")).drop("__break")


def composite_ids(calls: DataFrame, most: int = 200_000, compat: bool = False) -> DataFrame:
    """``segment_id`` of run and distance group: a text of both, or with ``compat`` their product, which collides."""
    both = distance_breaks(run_lengths(calls), most)
    return both.withColumn("segment_id", (F.col("cn_id") * F.col("join_region_id")).cast("string") if compat else F.concat_ws("_", "cn_id", "join_region_id"))


def rollup(calls: DataFrame, by: str = "cn_id") -> DataFrame:
    """One row for each run: state, extent, length, median coverage and median standardised distance.

    Where the rows have a region_name, region_names lists each once, in order of the regions. Where
    they have ``site_sums``, snp_baf is the weighted mean of alt over ref, and snp_weight the sum of
    the weights.
    """
    has = set(calls.columns)
    found = [
        F.min_by("cn_pred", "start").alias("cn_pred"), F.min("start").alias("start"), F.max("end").alias("end"), (F.max("end") - F.min("start")).alias("length"),
        F.median("cov").alias("median_cov"), F.median("sd_distance").alias("median_sd_distance"), F.count("*").alias("n_regions"),
    ]
    if "region_name" in has:
        named = F.transform(F.array_sort(F.collect_set(F.struct("start", "region_name"))), lambda x: x["region_name"])
        found.append(F.array_join(F.array_distinct(named), ",").alias("region_names"))
    if "snp_weight" in has:
        found += [F.try_divide(F.sum("snp_sum"), F.sum("snp_known")).alias("snp_baf"), F.sum("snp_weight").alias("snp_weight")]
    return calls.groupBy("sample", "chr", by).agg(*found)


def site_sums(sites: DataFrame, compat: bool = False) -> DataFrame:
    """(sample, chr, start, snp_sum, snp_known, snp_weight) of each region's sites, weighted by pop_het.

    A site's frequency is alt / (alt + ref), none without depth; with ``compat`` it is alt / ref, none
    without reference reads.
    """
    alt, ref = F.col("alt_count").cast("double"), F.col("ref_count").cast("double")
    ratio = F.try_divide(alt, ref if compat else alt + ref)
    known = F.when(ratio.isNotNull(), F.col("pop_het"))
    return sites.groupBy("sample", "chr", "start").agg(F.sum(ratio * F.col("pop_het")).alias("snp_sum"), F.sum(known).alias("snp_known"), F.sum("pop_het").alias("snp_weight"))


def named_regions(calls: DataFrame, regions: DataFrame) -> DataFrame:
    """Calls at regions of the dictionary, with its region_name; calls elsewhere are left out."""
    return calls.join(regions.select("chr", "start", "end", "region_name"), ["chr", "start", "end"])


def normal_levels(calls: DataFrame) -> DataFrame:
    """(sample, norm_cov): median over all regions of coverage over what the called copies make of the normal level.

    A region without copies that has coverage counts as infinitely high, one without either is left out.
    """
    factor = F.when(F.col("cn_pred") == "LOH", 1.0).otherwise(F.col("cn_pred").try_cast("double") / 2)
    level = F.when(factor > 0, F.col("cov") / factor).when(F.col("cov") > 0, float("inf"))
    return calls.groupBy("sample").agg(F.median(level).alias("norm_cov"))


def longest(segments: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` longest segments of a sample that are not normal."""
    order = Window.partitionBy("sample").orderBy(F.col("length").desc(), "chr", "start")
    return segments.where("cn_pred != '2'").withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= n)


def purity(segments: DataFrame, normals: DataFrame, genome: DataFrame, n: int = 3, cap: float = 0.99) -> DataFrame:
    """Purity that a sample's longest changed segments imply, weighted by length.

    A segment of c copies with coverage ratio q to the normal level (``normal_levels``) implies
    (q - 1) / (c / 2 - 1); LOH implies nothing.
    """
    top = longest(segments, n).join(normals, "sample").withColumn("copies", F.when(F.col("cn_pred") != "LOH", F.col("cn_pred")).try_cast("double"))
    implied = F.try_divide(F.try_divide(F.col("median_cov"), F.col("norm_cov")) - 1, F.col("copies") / 2 - 1)
    rows = top.withColumn("implied", implied).where("implied is not null")
    mean = rows.groupBy("sample").agg((F.sum(F.col("implied") * F.col("length")) / F.sum("length")).alias("purity_mean"), F.sum("length").alias("total"))
    around = rows.join(mean, "sample").groupBy("sample", "purity_mean", "total").agg(F.sqrt(F.sum(F.col("length") * (F.col("implied") - F.col("purity_mean")) ** 2) / F.sum("length")).alias("purity_sd"))
    share = F.round(100 * F.col("total") / F.col("genome_size"), 2)
    return around.join(genome, "sample").select("sample", F.least(F.lit(cap), "purity_mean").alias("purity"), "purity_sd", (F.col("total") / 1e6).alias("total_mbp"), share.alias("genome_percent"))


def genome_size(coverage: DataFrame) -> DataFrame:
    """(sample, genome_size): sum of the chromosomes' largest ends."""
    ends = coverage.groupBy("sample", "chr").agg(F.max("end").alias("e"))
    return ends.groupBy("sample").agg(F.sum("e").alias("genome_size"))


def rolling(calls: DataFrame, k: int = 50) -> DataFrame:
    """Mean and sum of ``k`` regions around each, 0 where the window is not whole; an even window has one more after."""
    before, after = (k - 1) // 2, k // 2
    frame = along().rowsBetween(-before, after)
    whole = F.count("*").over(frame) == k
    return calls.withColumn("roll_mean", F.when(whole, F.avg("cov").over(frame)).otherwise(0.0)).withColumn("roll_sum", F.when(whole, F.sum("cov").over(frame)).otherwise(0.0))


def chromosome_extents(regions: DataFrame) -> DataFrame:
    """First, last and middle ordinal of each chromosome among all regions in natural order."""
    from helixframe.functions.genome import chr_rank

    counts = regions.select("chr", "start", "end").distinct().groupBy("chr").agg(F.count("*").alias("n"))
    # One row for each chromosome.
    order = Window.orderBy(chr_rank(F.col("chr")), "chr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = counts.withColumn("last", F.sum("n").over(order))
    return last.select("chr", (F.col("last") - F.col("n") + 1).alias("first"), "last", (F.col("last") - (F.col("n") - 1) / 2).alias("middle"))


def central_depth(rows: DataFrame, by: tuple, order: str, value: str, width: int = 9, more_than: int = 10) -> DataFrame:
    """Mean of the ``width`` values around the middle one, n / 2 rounded half to even, of a group with more than ``more_than`` rows, else of all."""
    w = Window.partitionBy(*by)
    placed = rows.withColumn("i", F.row_number().over(w.orderBy(order))).withColumn("n", F.count("*").over(w))
    first = F.bround(F.col("n") / 2) - width // 2
    middle = (F.col("i") >= first) & (F.col("i") < first + width)
    return placed.groupBy(*by).agg(F.avg(F.when((F.col("n") <= more_than) | middle, F.col(value))).alias("depth"), F.max("n").alias("n"))


def axis_limits(segments: DataFrame, floors: tuple = (0, 15)) -> DataFrame:
    """(contig, axis_limit_F for each floor F): the int(0.99 n)-th smallest deviation from 2 copies, at least F, rounded up.

    A contig with one segment has no such deviation and takes the floor; null copy numbers don't
    count. Copy numbers have two decimals, so equal deviations are counted before they meet.
    """
    counts = segments.groupBy("contig", F.abs(F.col("cn") - 2).alias("v")).agg(F.count("cn").alias("k"))
    contig = Window.partitionBy("contig")
    until, rank = F.sum("k").over(contig.orderBy("v")), F.floor(F.sum("k").over(contig) * 0.99)
    ranked = counts.select("contig", "v", ((rank >= 1) & (until >= rank)).alias("reached"))
    value = F.min(F.when(F.col("reached"), F.col("v")))
    return ranked.groupBy("contig").agg(*(F.ceil(F.greatest(F.lit(float(f)), value)).cast("long").alias(f"axis_limit_{f}") for f in floors))
