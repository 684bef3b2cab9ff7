"""Cohort logic: adding earlier samples, recurrence of calls, comparing samples, merging callers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_cohort(batch: DataFrame, cohort: DataFrame) -> DataFrame:
    """Batch rows of type call and, as type cohort, the cohort's rows of other samples."""
    earlier = cohort.join(batch.select("sample").distinct(), "sample", "left_anti")
    return batch.withColumn("type", F.lit("call")).unionByName(earlier.withColumn("type", F.lit("cohort")), allowMissingColumns=True)


def known_elsewhere(batch: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of the cohort at regions that the batch has, with a coverage, of samples that the batch does not have, as type cohort."""
    regions = batch.select("chr", "start", "end").distinct()
    earlier = cohort.where("cov is not null").join(batch.select("sample").distinct(), "sample", "left_anti")
    return earlier.join(regions, ["chr", "start", "end"]).withColumn("type", F.lit("cohort"))


def recurrence(calls: DataFrame, most: float, cohort: DataFrame | None = None) -> DataFrame:
    """Calls with the number of samples that share region and state, and ``final_cn``: too common states are normal.

    Samples of an earlier ``cohort`` (sample, chr, start, end, cn_pred) count with the batch's.
    """
    keys = ["chr", "start", "end", "cn_pred"]
    every = calls.select("sample", *keys)
    if cohort is not None:
        every = every.unionByName(cohort.select("sample", *keys).join(calls.select("sample").distinct(), "sample", "left_anti"))
    n = every.agg(F.count_distinct("sample").alias("samples_in_cohort"))
    shared = every.groupBy(*keys).agg(F.count_distinct("sample").alias("cnv_in_cohort"))
    met = calls.join(shared, keys).join(F.broadcast(n))
    common = (F.col("cn_pred") != "2") & (F.col("cnv_in_cohort") / F.col("samples_in_cohort") > most)
    return met.withColumn("final_cn", F.when(common, "2").otherwise(F.col("cn_pred")))


def too_frequent(recurrent: DataFrame) -> DataFrame:
    """The calls that ``recurrence`` made normal, as they were called."""
    return recurrent.where("cn_pred != final_cn")


def cohort_info(calls: DataFrame, cohort: DataFrame | None = None) -> DataFrame:
    """What a later run needs of these calls (those of the columns that they have), after the earlier cohort's rows."""
    kept = calls.select(*[c for c in ("sample", "chr", "start", "end", "cn_pred", "cov_raw", "cov", "pos", "alt_count", "ref_count") if c in calls.columns])
    if cohort is None:
        return kept
    return cohort.join(calls.select("sample").distinct(), "sample", "left_anti").unionByName(kept, allowMissingColumns=True)


def earlier_frequency(calls: DataFrame, cohort: DataFrame) -> DataFrame:
    """``earlier``: number of cohort samples with the same region and state, 0 if none."""
    shared = cohort.groupBy("chr", "start", "end", "cn_pred").agg(F.count_distinct("sample").alias("earlier"))
    return calls.join(shared, ["chr", "start", "end", "cn_pred"], "left").withColumn("earlier", F.coalesce("earlier", F.lit(0).cast("long")))


def copies(state: Column) -> Column:
    """Number of copies of a state; LOH has two."""
    return F.when(state == "LOH", 2).otherwise(state.cast("int"))


def compare_samples(calls: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rollup of regions for (target, compared) pairs: state and coverage differences by both samples' runs."""
    keep = ["chr", "start", "end", "cn_pred", "cn_id", "cov"]
    one = calls.select(F.col("sample").alias("target"), *keep[:3], *[F.col(c).alias(f"target_{c}") for c in keep[3:]])
    two = calls.select(F.col("sample").alias("compared"), *keep[:3], *[F.col(c).alias(f"compared_{c}") for c in keep[3:]])
    met = one.join(F.broadcast(pairs), "target").join(two, ["compared", "chr", "start", "end"])
    return met.groupBy("target", "compared", "chr", "target_cn_id", "compared_cn_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.first(copies(F.col("target_cn_pred")) - copies(F.col("compared_cn_pred"))).alias("cn_difference"),
        F.median("target_cov").alias("target_median"), F.median("compared_cov").alias("compared_median"),
        (F.median("target_cov") - F.median("compared_cov")).alias("median_difference"),
    )


def comparison_pairs(spec: DataFrame, column: str) -> DataFrame:
    """Distinct (target, compared) of texts like ``a::b|c::d``."""
    pair = F.explode(F.split(F.col(column), r"\|"))
    return spec.select(pair.alias("pair")).select(F.split_part("pair", F.lit("::"), F.lit(1)).alias("target"), F.split_part("pair", F.lit("::"), F.lit(2)).alias("compared")).distinct()


def control_differences(coverage: DataFrame, control: str, least_difference: float, join_within: int, not_in_samples: int | None = None, longer_than: int = 0) -> DataFrame:
    """Stretches of regions whose coverage is off the control sample's by a share; near stretches are one.

    Stretches that on average lie in just ``not_in_samples`` samples, and those not ``longer_than``
    so many positions, are left out.
    """
    base = coverage.where(F.col("sample") == control).select("chr", "start", "end", F.col("cov").alias("control_cov"))
    met = coverage.where(F.col("sample") != control).join(base, ["chr", "start", "end"])
    diff = F.try_divide(F.col("cov") - F.col("control_cov"), F.col("control_cov"))
    off = met.withColumn("rel_diff", diff).where(F.abs("rel_diff") > least_difference)
    shared = off.groupBy("chr", "start", "end").agg(F.count("*").alias("in_samples"))
    along = Window.partitionBy("sample", "chr").orderBy("start")
    fresh = F.coalesce((F.col("start") - F.lag("end").over(along) > join_within).cast("int"), F.lit(1))
    runs = off.join(shared, ["chr", "start", "end"]).withColumn("__new", fresh).withColumn("stretch", F.sum("__new").over(along).cast("long"))
    found = runs.groupBy("sample", "chr", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.avg("rel_diff").alias("mean_diff"), F.avg("in_samples").alias("mean_in_samples"), F.count("*").alias("n_regions"))
    found = found.where(F.col("end") - F.col("start") > longer_than)
    return found if not_in_samples is None else found.where(F.col("mean_in_samples") != not_in_samples)


def paired_donors(sheet: DataFrame) -> DataFrame:
    """(donor, tumor, normal) of donors with both."""
    side = lambda kind: sheet.where(F.col("tumor_normal") == kind).select("donor", F.col("sample_name").alias(kind))
    return side("tumor").join(side("normal"), "donor")


def complete_grid(coverage: DataFrame) -> DataFrame:
    """Every sample and region, coverage 0 where a sample lacks one."""
    samples = coverage.select("sample").distinct()
    regions = coverage.select("chr", "start", "end").distinct()
    grid = regions.join(F.broadcast(samples))
    return grid.join(coverage, ["sample", "chr", "start", "end"], "left").withColumn("cov", F.coalesce("cov", F.lit(0.0)))
