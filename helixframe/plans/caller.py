"""The copy-number caller: from coverage, and what else is known, to segments that are not normal."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.model import STATES
from helixframe.operators import cohort as cohorts
from helixframe.operators import fit, hmm, intervals, likelihood, normalize, segments
from helixframe.operators.shared import materialize

REGION = ("sample", "chr", "start", "end")


@dataclass(frozen=True)
class CallerConfig:
    """Options of a run; presence of evidence is an option here, not a guess from column names.

    ``library`` is panel (normal tails around similar samples) or wgs (one negative binomial of the
    last type of samples by name), ``calling`` germline, tumor_only or tumor_normal.
    """

    library: str = "panel"
    calling: str = "germline"
    least_region: int = 20
    least_correlation: float = 0.9
    most_in_cohort: float = 1.0
    autosomes_only: bool = False
    estimate_first: bool = False
    missing_load: float = 0.1
    cap: float = 0.99
    longest: int = 3
    site_depth: int = 20
    isolate: bool = True

    @property
    def initial_load(self) -> float:
        return 1.0 if self.calling == "germline" else 0.75

    @property
    def iterations(self) -> int:
        return 1 if self.calling == "germline" else 3


class Called(NamedTuple):
    """``regions`` with their states, ``segments`` that are not normal, what was ``too_frequent``, ``purities``, the ``cohort`` for later runs and ``errors``."""

    regions: DataFrame
    segments: DataFrame
    too_frequent: DataFrame
    purities: DataFrame
    cohort: DataFrame
    errors: DataFrame


def prepared(coverage: DataFrame, config: CallerConfig, regions: DataFrame | None = None, gc: DataFrame | None = None, bands: DataFrame | None = None, cohort: DataFrame | None = None) -> DataFrame:
    """Trimmed and normalised coverage of the batch, and of the cohort's samples at its regions, with a type.

    ``regions`` (chr, start, end, region_name, region_id) is the dictionary, ``gc`` (chr, start, gc),
    ``bands`` (chr, start, end, band_type), ``cohort`` an earlier run's rows with cov.
    """
    batch = coverage if "type" in coverage.columns else coverage.withColumn("type", F.lit("call"))
    if regions is not None:
        batch = intervals.at_known_regions(batch, regions)
    if config.autosomes_only:
        batch = intervals.keep_autosomes(batch)
    batch = intervals.trim_overlaps(batch, ("sample", "chr"), config.least_region)
    earlier = None if cohort is None else cohorts.known_elsewhere(batch, cohort)
    rows = normalize.library_size(batch, earlier)
    if earlier is not None:
        rows = rows.unionByName(earlier.select(*[c for c in rows.columns if c in earlier.columns]), allowMissingColumns=True)
    if config.library == "wgs" and bands is not None:
        rows = intervals.outside_centromeres(rows, bands)
    if gc is not None:
        normed = materialize(normalize.gc_regression(rows.join(gc.select("chr", "start", "gc"), ["chr", "start"])))
        kept = normalize.gc_outliers(normed).select("chr", "start", "end")
        rows = normed.join(kept, ["chr", "start", "end"], "left_semi").withColumn("cov", F.col("cov_norm")).drop("gc", "slope", "intercept", "cov_norm")
    return rows


def with_distribution(rows: DataFrame, config: CallerConfig) -> DataFrame:
    """``m`` and ``v``: mean and, for a panel, deviation of a region over similar samples, else mean and variance of one fit."""
    if config.library == "panel":
        weights = normalize.sample_correlation(rows, config.least_correlation)
        moments = normalize.weighted_moments(rows, weights)
        return rows.join(moments.withColumnsRenamed({"w_mean": "m", "w_sd": "v"}), ["sample", "chr", "start"])
    last = rows.agg(F.max("type")).first()[0]
    size, mean, _ = fit.trimmed_fit(rows.where(F.col("type") == last), "cov")
    return rows.withColumn("m", F.lit(mean)).withColumn("v", F.lit(mean + mean * mean / size))


def sites_at_regions(sites: DataFrame, rows: DataFrame, config: CallerConfig) -> DataFrame:
    """Sites (sample, chr, pos, pop_het, alt_count, ref_count) with the region that owns them; sites of little depth in every sample go."""
    regions = rows.select("chr", "start", "end").distinct().withColumn("region_id", F.col("start"))
    places = sites.groupBy("chr", "pos").agg(F.max("pop_het").alias("pop_het"), F.max(F.col("alt_count") + F.col("ref_count")).alias("deepest")).where(F.col("deepest") > config.site_depth)
    owned = intervals.owned_points(places.withColumn("site", F.col("pos")), regions, 100_000).select("chr", "pos", "start", "end")
    return sites.join(owned, ["chr", "pos"])


def _costs(rows: DataFrame, sites: DataFrame | None, tails: DataFrame | None, config: CallerConfig, states: tuple) -> DataFrame:
    mean, spread = F.col("m"), F.col("v")
    score = likelihood.normal_coverage if config.library == "panel" else likelihood.nb_coverage
    covered = score(rows, mean, spread, F.col("load"), states)
    if sites is None:
        return covered
    return likelihood.add_site_costs(covered, likelihood.snp_states(sites, "load", tails), REGION)


def call(
    coverage: DataFrame, config: CallerConfig = CallerConfig(), *, regions: DataFrame | None = None, sites: DataFrame | None = None,
    gc: DataFrame | None = None, bands: DataFrame | None = None, cohort: DataFrame | None = None,
) -> Called:
    """Call the states of all regions of all samples of type call.

    ``coverage`` has (sample, chr, start, end, cov_raw) and, for tumor_normal, a type. States with
    loss of heterozygosity are called where there are ``sites``. Somatic runs decode three times;
    between, a sample's purity follows from its longest changed segments, ``missing_load`` where it
    has none. A sample that fails in a round is left out and listed in ``errors``. Each round is
    written to the shared folder.
    """
    prepared_rows = materialize(prepared(coverage, config, regions, gc, bands, cohort))
    rows = materialize(with_distribution(prepared_rows, config).where("type = 'call'"))
    spots = None if sites is None else materialize(sites_at_regions(sites, prepared_rows, config))
    # What does not depend on the tumour's share is scored once for all rounds.
    tails = None if sites is None else materialize(likelihood.homozygote_tails(spots))
    states = STATES if sites is not None else tuple(s for s in STATES if s != "LOH")
    samples = rows.select("sample").distinct()
    loads = samples.withColumn("load", F.lit(config.initial_load))
    if config.estimate_first and config.calling != "germline" and config.library == "wgs":
        first = fit.purity_prior(rows).select("sample", "purity")
        loads = samples.join(first, "sample", "left").select("sample", F.coalesce(F.nanvl("purity", F.lit(config.initial_load)), F.lit(config.initial_load)).alias("load"))
    loads, failed, called = materialize(loads), [], None
    for i in range(config.iterations):
        # One row for each sample; Spark broadcasts them by their size.
        known = None if spots is None else spots.join(loads, "sample")
        decoded = materialize(hmm.decode(_costs(rows.join(loads, "sample"), known, tails, config, states), states, config.isolate))
        if config.isolate:
            decoded, errors = hmm.without_failures(decoded)
            failed.append(errors)
        called = segments.run_lengths(decoded)
        if i + 1 < config.iterations:
            found = segments.purity(segments.rollup(called.withColumn("sd_distance", F.lit(0.0))), segments.normal_levels(called), segments.genome_size(called), config.longest, config.cap)
            estimated = loads.select("sample").join(found.select("sample", "purity"), "sample", "left")
            loads = materialize(estimated.select("sample", F.when(F.col("purity").isNotNull(), F.greatest("purity", F.lit(0.0))).otherwise(config.missing_load).alias("load")))
    spread = F.col("v") if config.library == "panel" else F.sqrt("v")
    extra = [c for c in ("cov_raw", "region_name", "region_id", "m", "v") if c in rows.columns]
    full = called.join(rows.select(*REGION, *extra), list(REGION)).withColumn("sd_distance", F.try_divide(F.col("cov") - F.col("m"), spread))
    recurrent = cohorts.recurrence(full, config.most_in_cohort, None if cohort is None or "cn_pred" not in cohort.columns else cohort)
    final = materialize(recurrent.withColumn("called", F.col("cn_pred")))
    shown = final.withColumn("cn_pred", F.col("final_cn")).drop("final_cn", "called", "cn_id")
    runs = segments.composite_ids(shown)
    if spots is not None:
        runs = runs.join(segments.site_sums(spots), ["sample", "chr", "start"], "left")
    changed = segments.rollup(runs, "segment_id").where("cn_pred != '2'").drop("segment_id")
    errors = failed[0] if failed else rows.select("sample", "chr", F.lit(None).cast("string").alias("error")).limit(0)
    for more in failed[1:]:
        errors = errors.unionByName(more)
    return Called(shown, changed, cohorts.too_frequent(final).drop("called"), loads, cohorts.cohort_info(final.drop("final_cn", "called"), cohort), errors.distinct())
