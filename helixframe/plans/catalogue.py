"""Registered queries of the genomic operators: name to (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions.genome import logistic
from helixframe.functions.model import DISTANCE, DISTANCE_SCALE, STATES, prior, transitions
from helixframe.operators import cohort, fit, hmm, intervals, likelihood, normalize, segments, variants
from helixframe.plans import oracles, views
from helixframe.plans.caller import CallerConfig, call

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _sizes(s, d):
    return views.reads(s, d).groupBy("chr").agg((F.max("pos") + 1).alias("chr_size"))


def _bands(s, d):
    return views.bins(s, d).withColumn("band_type", F.when(F.expr("start div 86400").isin(12, 13), "acen").otherwise("gneg"))


def _with_gc(s, d):
    return normalize.library_size(views.coverage(s, d)).withColumn("gc", F.expr("(start div 86400) * 7 % 30 / 60.0D + 0.2D"))


def _plain(s, d):
    return views.coverage(s, d).withColumn("cov", F.col("cov_raw").cast("double"))


def _alleles(s, d):
    """(sample, site, n_a, n_c, n_g, n_t, cov, alt, alt_count, ref_count, baf)."""
    wide = views.pile(s, d).groupBy("sample", "site").pivot("base", ["A", "C", "G", "T"]).agg(F.sum("n"))
    count = {b: F.coalesce(F.col(b), F.lit(0.0)).cast("long").alias(f"n_{b.lower()}") for b in "ACGT"}
    met = wide.select("sample", "site", *count.values()).join(views.snps(s, d).select("site", "chr", "pos", "alt", "baf"), "site")
    alt = F.element_at(F.create_map(*[x for b in "ACGT" for x in (F.lit(b), F.col(f"n_{b.lower()}"))]), F.col("alt"))
    cov = F.col("n_a") + F.col("n_c") + F.col("n_g") + F.col("n_t")
    return met.withColumn("cov", cov).withColumn("alt_count", alt).withColumn("ref_count", F.col("cov") - F.col("alt_count"))


def _nb(s, d):
    own = Window.partitionBy("sample")
    rows = _plain(s, d).withColumn("m", F.avg("cov").over(own)).withColumn("v", F.var_samp("cov").over(own))
    return likelihood.nb_coverage(rows, F.col("m"), F.col("v"))


def _snp_likelihood(s, d):
    rows = _alleles(s, d).withColumn("pop_het", 2 * F.col("baf") * (1 - F.col("baf")))
    return likelihood.snp_states(rows)


def _long(df, *keys):
    return df.select(*keys, F.posexplode("nll").alias("state", "nll")).withColumn("nll", F.round("nll", 6))


def _runs(s, d):
    own = Window.partitionBy("sample")
    distance = F.try_divide(F.col("cov") - F.avg("cov").over(own), F.stddev_samp("cov").over(own))
    return segments.run_lengths(views.calls(s, d)).withColumn("sd_distance", distance)


def _svs(s, d, shift=0):
    start = F.col("p_partkey") % 200 * 50 + shift
    return views.table(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("chr"), start.alias("start"), (start + F.col("p_size") * 100).alias("end"), F.when(F.col("p_size") % 2 == 0, "DEL").otherwise("DUP").alias("svtype"), "p_size")


@query
def genome_binning(s: SparkSession, d: str) -> DataFrame:
    return intervals.genome_bins(_sizes(s, d), 50_000)


@query
def genome_binning_overlap(s, d):
    return intervals.genome_bins(_sizes(s, d), 50_000, 5_000)


@query
def small_bin_filter(s, d):
    return intervals.keep_wide_bins(intervals.genome_bins(_sizes(s, d), 50_000))


@query
def depth_per_bin(s, d):
    return views.coverage(s, d)


@query
def depth_of_any_regions(s, d):
    """Reads of one hour that overlap the panel's regions, which overlap and have many lengths."""
    panel = views.panel(s, d).select(F.element_at(F.array(*map(F.lit, views.CHROMOSOMES)), (1 + F.col("ordinal") % 5).cast("int")).alias("chr"), "start", "end")
    reads = views.reads(s, d).select("sample", "chr", F.col("pos").alias("start"), (F.col("pos") + 3600).alias("end"))
    return intervals.region_depth(reads, panel, 1_000)


@query
def autosome_filter(s, d):
    rows = views.table(s, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("chr"), (F.col("p_size") % 30).cast("string")).alias("chr"))
    return intervals.keep_autosomes(rows)


@query
def cohort_mean_norm(s, d):
    """The batch's coverage scaled to the mean of an earlier cohort's."""
    rows = views.coverage(s, d)
    cohort = rows.where("sample >= 's7'").withColumn("cov", F.col("cov_raw").cast("double"))
    return rounded(normalize.library_size(rows.where("sample < 's7'"), cohort).select("sample", "chr", "start", "cov"), "cov")


@query
def library_size_norm(s, d):
    return rounded(normalize.library_size(views.coverage(s, d)).select("sample", "chr", "start", "end", "cov_raw", "cov"), "cov")


@query
def coverage_clip(s, d):
    mean = F.avg("cov_raw").over(Window.partitionBy("sample"))
    return rounded(views.coverage(s, d).select("sample", "chr", "start", F.least(F.col("cov_raw").cast("double"), 3 * mean).alias("clipped")), "clipped")


@query
def overlap_trim(s, d):
    return intervals.trim_overlaps(views.panel(s, d)).select("chr", "start", "end", "region_name")


@query
def interbin_distance(s, d):
    far = intervals.distances(views.panel(s, d))
    t = F.coalesce(1 - logistic(F.col("dist").cast("double"), 50_000.0, 10_000.0), F.lit(0.0))
    return far.select("chr", "start", "dist", F.round(t, 6).alias("t"))


@query
def gap_finder(s, d):
    return intervals.gaps(views.panel(s, d), 60_000)


@query
def panel_name_dedup(s, d):
    return intervals.name_regions(views.panel(s, d)).select("chr", "start", "end", "region_name", "region_id")


@query
def centromere_antijoin(s, d):
    return intervals.outside_centromeres(views.coverage(s, d), _bands(s, d)).select("sample", "chr", "start", "end", "cov_raw")


@query
def gc_content(s, d):
    return rounded(normalize.gc_content(views.table(s, d, "documents"), "doc_id", "text"), "gc")


@query
def gc_regression_norm(s, d):
    found = normalize.gc_regression(_with_gc(s, d))
    return rounded(found.select("sample", "chr", "start", "gc", "slope", "intercept", "cov_norm"), "gc", "slope", "intercept", "cov_norm", digits=5)


@query
def gc_bin_outliers(s, d):
    return normalize.gc_outliers(normalize.gc_regression(_with_gc(s, d)), deviations=2.0, most=3, spread=2.0, complete=0.8)


@query
def snp_point_in_region(s, d):
    part = views.table(s, d, "part")
    points = part.select(F.col("p_partkey").alias("site"), F.col("p_brand").alias("chr"), (F.col("p_partkey") * 1000 + F.col("p_size") * 131 % 3000).alias("pos"), (2 * (F.col("p_size") / F.lit(51.0)) * (1 - F.col("p_size") / F.lit(51.0))).alias("pop_het"))
    return intervals.owned_points(points, intervals.name_regions(views.panel(s, d)), 10_000).select("site", "chr", "pos", "region_id")


@query
def allele_pivot(s, d):
    return _alleles(s, d).select("sample", "site", "n_a", "n_c", "n_g", "n_t", "alt_count", "ref_count")


@query
def het_prior_and_depth_filter(s, d):
    deepest = F.max("cov").over(Window.partitionBy("site"))
    return _alleles(s, d).withColumn("deepest", deepest).where("deepest > 20").select("sample", "site", "cov", F.round(2 * F.col("baf") * (1 - F.col("baf")), 6).alias("pop_het"))


@query
def sample_correlation(s, d):
    return rounded(normalize.sample_correlation(_plain(s, d), 0.0), "r", "weight")


@query
def norm_weights(s, d):
    return rounded(normalize.norm_weights(normalize.sample_correlation(_plain(s, d), 0.0)), "norm_weight")


@query
def similarity_weights(s, d):
    rows = _plain(s, d)
    r = normalize.sample_correlation(rows).withColumn("r", 0.5 + F.col("r") / 2)
    return fit.similarity_weights(rows, r).select("target", "sample", "chr", "start", F.col("weight").cast("long").alias("weight"), "n")


@query
def similar_samples_fit(s, d):
    """The likeliest negative binomial of each target and region, over samples weighted by their similarity."""
    rows = _plain(s, d)
    r = normalize.sample_correlation(rows).withColumn("r", 0.5 + F.col("r") / 2)
    return rounded(fit.weighted_nb_fit(fit.similarity_weights(rows, r), ("target", "chr", "start")), "size", "mean", digits=4)


@query
def weighted_mean_sd(s, d):
    rows = _plain(s, d)
    return rounded(normalize.weighted_moments(rows, normalize.sample_correlation(rows, 0.0)), "w_mean", "w_sd", digits=5)


@query
def panel_moments_with_holes(s, d):
    """Moments over similar samples where samples lack regions, which then count as 0."""
    rows = _plain(s, d).where("(start div 86400 + cast(substring(sample, 2) as int)) % 7 != 0")
    return rounded(normalize.weighted_moments(rows, normalize.sample_correlation(rows, 0.0)), "w_mean", "w_sd", digits=4)


@query
def nb_likelihood(s, d):
    return _long(_nb(s, d), "sample", "chr", "start")


@query
def normal_tail_likelihood(s, d):
    own = Window.partitionBy("sample")
    rows = _plain(s, d).withColumn("m", F.avg("cov").over(own)).withColumn("sd", F.stddev_samp("cov").over(own))
    return _long(likelihood.normal_coverage(rows, F.col("m"), F.col("sd"), load=0.75), "sample", "chr", "start")


@query
def snp_state_posterior(s, d):
    return _long(_snp_likelihood(s, d), "sample", "site")


@query
def evidence_sum(s, d):
    placed = _snp_likelihood(s, d).withColumn("start", F.expr("pos div 86400") * 86400)
    at_bins = placed.join(views.bins(s, d), ["chr", "start"])
    return rounded(likelihood.combine(_nb(s, d), at_bins).drop("end"), "nll", digits=4)


@query
def probability_profile(s, d):
    return rounded(likelihood.probability_profile(_nb(s, d)), "share")


@query
def run_length_segments(s, d):
    return segments.run_lengths(views.calls(s, d)).select("sample", "chr", "start", "cn_pred", "cn_id")


@query
def distance_break_groups(s, d):
    rows = views.calls(s, d).where(~F.expr("start div 86400 % 7").isin(3, 4, 5))
    return segments.composite_ids(rows).select("sample", "chr", "start", "join_region_id", "cn_id", "segment_id")


@query
def segment_rollup_median(s, d):
    return rounded(segments.rollup(_runs(s, d)), "median_cov", "median_sd_distance")


@query
def top3_longest_segments(s, d):
    return segments.longest(segments.rollup(_runs(s, d))).select("sample", "place", "chr", "start", "end", "cn_pred", "length")


@query
def purity_from_segments(s, d):
    rows = views.calls(s, d)
    return rounded(segments.purity(segments.rollup(_runs(s, d)), segments.normal_levels(rows), segments.genome_size(rows)), "purity", "purity_sd", "total_mbp", "genome_percent")


@query
def named_segments_with_snps(s, d):
    """Segments with the names of their regions and the allele ratio of the sites in them."""
    names = views.bins(s, d).select("chr", "start", "end", F.concat(F.lit("r"), F.expr("start div 86400 div 2")).alias("region_name"))
    sites = _alleles(s, d).select("sample", "chr", (F.expr("pos div 86400") * 86400).alias("start"), "alt_count", "ref_count", (2 * F.col("baf") * (1 - F.col("baf"))).alias("pop_het"))
    runs = segments.named_regions(_runs(s, d), names).join(segments.site_sums(sites), ["sample", "chr", "start"], "left")
    found = segments.rollup(runs).select("sample", "chr", "cn_id", "cn_pred", "start", "end", "length", "region_names", "snp_baf", "snp_weight")
    return rounded(found, "snp_baf", "snp_weight")


@query
def rolling_mean_10(s, d):
    return rounded(segments.rolling(views.calls(s, d), 10).select("sample", "chr", "start", "roll_mean", "roll_sum"), "roll_mean")


@query
def chromosome_extents(s, d):
    return segments.chromosome_extents(views.panel(s, d))


@query
def central_window_depth(s, d):
    return rounded(segments.central_depth(views.reads(s, d), ("sample", "chr"), "event_id", "value"), "depth")


@query
def cohort_recurrence(s, d):
    return cohort.recurrence(views.calls(s, d), 0.3).select("sample", "chr", "start", "cn_pred", "cnv_in_cohort", "samples_in_cohort", "final_cn")


@query
def too_frequent_calls(s, d):
    """Calls of the batch that too many samples of the batch and an earlier cohort share."""
    rows = views.calls(s, d)
    found = cohort.too_frequent(cohort.recurrence(rows.where("sample < 's7'"), 0.3, rows.where("sample >= 's5'")))
    return found.select("sample", "chr", "start", "cn_pred", "cnv_in_cohort", "samples_in_cohort", "final_cn")


@query
def cohort_info(s, d):
    rows = views.calls(s, d)
    return cohort.cohort_info(rows.where("sample < 's7'"), rows.where("sample >= 's5'").select("sample", "chr", "start", "end", "cn_pred", "cov_raw", "cov"))


@query
def cohort_antijoin_union(s, d):
    rows = views.coverage(s, d)
    return cohort.with_cohort(rows.where("sample < 's7'"), rows.where("sample >= 's5'")).select("sample", "chr", "start", "cov_raw", "type")


@query
def previous_cohort_freq(s, d):
    rows = views.calls(s, d)
    return cohort.earlier_frequency(rows.where("sample < 's7'"), rows.where("sample >= 's7'")).select("sample", "chr", "start", "cn_pred", "earlier")


@query
def control_sample_diff(s, d):
    return rounded(cohort.control_differences(_plain(s, d), "s0", 0.9, 200_000), "mean_diff", "mean_in_samples")


@query
def control_sample_stretches(s, d):
    """The same without short stretches and those that three samples share."""
    return rounded(cohort.control_differences(_plain(s, d), "s0", 0.9, 200_000, 3, 200_000), "mean_diff", "mean_in_samples")


@query
def sample_comparison(s, d):
    pairs = cohort.comparison_pairs(s.createDataFrame([("s0::s1|s2::s3|s0::s1",)], "spec string"), "spec")
    return rounded(cohort.compare_samples(_runs(s, d), pairs), "target_median", "compared_median", "median_difference")


@query
def comparison_spec_pairs(s, d):
    n = F.col("n_nationkey")
    text = F.concat(F.lit("s"), (n % 3).cast("string"), F.lit("::s"), (n % 5).cast("string"), F.lit("|s0::"), F.col("n_name"))
    return cohort.comparison_pairs(views.table(s, d, "nation").select(text.alias("spec")), "spec")


@query
def tumor_normal_pairs(s, d):
    sheet = views.table(s, d, "customer").select(F.col("c_name").alias("sample_name"), F.expr("c_custkey div 2").alias("donor"), F.when(F.col("c_custkey") % 2 == 0, "tumor").otherwise("normal").alias("tumor_normal"))
    return cohort.paired_donors(sheet)


@query
def grid_completion(s, d):
    rows = _plain(s, d).where("cov_raw > 200 and start div 86400 % 3 != 0").select("sample", "chr", "start", "end", "cov")
    return cohort.complete_grid(rows)


@query
def segment_to_cn(s, d):
    return variants.segment_copy_numbers(views.segments(s, d))


@query
def cn_without_purity(s, d):
    return rounded(variants.segment_copy_numbers(views.segments(s, d), tumour_content=None), "ccn")


def _probed(s, d):
    n = F.expr("start div 1000")
    return variants.segment_copy_numbers(views.segments(s, d)).withColumns({"n_probes": n % 50, "n_baf_probes": n % 3, "baf": (n % 50) / 100})


@query
def vcf_records(s, d):
    return variants.vcf_lines(_probed(s, d))


@query
def vcf_records_of_depths(s, d):
    """Records of a caller that gives a depth and, for some segments, an allele frequency, but no corrected number."""
    rows = _probed(s, d).drop("n_baf_probes", "ccn").withColumn("depth", F.col("n_probes") * 1.5)
    return variants.vcf_lines(rows.withColumn("baf", F.when(F.col("n_probes") % 2 == 0, F.col("baf"))))


def _small(s, d):
    i = views.table(s, d, "lineitem")
    c = F.col
    return i.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", c("l_returnflag").alias("chr"), c("l_orderkey").alias("pos"), c("l_orderkey").alias("start"), (c("l_orderkey") + c("l_linenumber") * 30).alias("end"),
        F.substring(F.lit("AAAA"), F.lit(1), 1 + c("l_partkey") % 3).alias("ref"), F.lit("A").alias("alt"), c("l_quantity").alias("dp"), c("l_linenumber").alias("vd"), c("l_discount").alias("af"), (c("l_tax") * 4).alias("hiaf"), c("l_linenumber").alias("hicnt"),
        (c("l_suppkey") % 20).alias("pmean"), (c("l_partkey") % 2).alias("pstd"), c("l_quantity").alias("qual"), (c("l_partkey") % 60).alias("mapq"), (c("l_linenumber") * F.lit(0.7)).alias("sn"), (c("l_suppkey") % 10).alias("nm"),
        (c("l_partkey") % 15).alias("msi"), (c("l_linenumber") % 3).alias("msilen"), F.when(c("l_linenumber") % 2 == 0, "2;1").otherwise("2;2").alias("bias"), (c("l_tax") / 10).alias("sbf"), (c("l_quantity") / 10).alias("oddratio"),
        F.when(c("l_partkey") % 4 == 0, (c("l_suppkey") % 2).cast("string")).alias("ampflag"), (c("l_suppkey") % 5).alias("gamp"), (c("l_suppkey") % 6).alias("tamp"), (c("l_partkey") % 2).alias("ncamp"),
        F.when(c("l_linenumber") < 5, "SNV").otherwise("Insertion").alias("type"), F.concat(F.lit("s "), (c("l_suppkey") % 10).cast("string")).alias("sample"),
        (c("l_partkey") % 9).alias("rfwd"), (c("l_suppkey") % 9).alias("rrev"), (c("l_linenumber") % 3).alias("vfwd"), (c("l_linenumber") % 2).alias("vrev"),
    )


@query
def small_variant_filters(s, d):
    return variants.hard_filters(_small(s, d)).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "filter", "gt", "qual_vcf")


@query
def small_variant_vcf(s, d):
    return variants.small_variant_lines(variants.hard_filters(_small(s, d)))


@query
def structural_variant_vcf(s, d):
    """Records with structural alternatives among them, those without split reads left out."""
    i, key, other = F.col("ampflag").isNull(), F.col("l_orderkey"), F.col("l_partkey")
    alt = F.when(i & (key % 3 == 0), F.when(other % 2 == 0, "<DEL>").otherwise("<INV>")).otherwise(F.col("alt"))
    reads = F.concat_ws("-", (F.col("l_suppkey") % 3).cast("string"), (other % 5).cast("string"), F.lit("1"))
    found = variants.hard_filters(_small(s, d)).withColumn("alt", alt)
    return variants.small_variant_lines(found.withColumn("tamp", F.when(i & (other % 7 != 0), reads).otherwise(F.col("tamp").cast("string"))))


@query
def every_variant_once(s, d):
    rows = _small(s, d)
    return variants.best_per_position(rows, ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"), every=True).select("chr", "start", "end", "ref", "alt", "af", "l_partkey", "l_suppkey", "l_linenumber")


@query
def best_variant_per_pos(s, d):
    rows = _small(s, d)
    return variants.best_per_position(rows, ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")).select("chr", "pos", "af", "l_partkey", "l_suppkey", "l_linenumber")


@query
def cluster_filter(s, d):
    kind = F.when(F.col("o_orderkey") % 7 == 0, "Deletion").otherwise("SNV")
    filters = F.when(F.col("o_totalprice") > 200_000, "PASS").otherwise("q22.5")
    rows = views.table(s, d, "orders").select(F.col("o_orderstatus").alias("chr"), F.col("o_orderkey").alias("pos"), kind.alias("type"), filters.alias("filter"))
    return variants.flag_clusters(rows, 7)


@query
def annotation_filter(s, d):
    info = F.concat(F.lit("DP="), F.col("l_quantity").cast("int").cast("string"), F.lit(";MAX_AF="), F.col("l_discount").cast("string"))
    rows = views.table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", F.str_to_map(info, F.lit(";"), F.lit("=")).alias("info"))
    return variants.keep_annotated(rows, least_depth=40, least_af=0.05).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@query
def annotation_filter_defaults(s, d):
    """The same with the thresholds that are the default."""
    info = F.concat(F.lit("DP="), (F.col("l_quantity") * 2).cast("int").cast("string"), F.lit(";MAX_AF="), (F.col("l_discount") / 50).cast("string"))
    rows = views.table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", F.str_to_map(info, F.lit(";"), F.lit("=")).alias("info"))
    return variants.keep_annotated(rows).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@query
def typed_line_filter(s, d):
    kinds = F.array(*map(F.lit, ["SNV", "DUP", "INV", "DEL", "Insertion"]))
    line = F.concat(F.col("p_partkey").cast("string"), F.lit("\tTYPE="), F.element_at(kinds, (1 + F.col("p_size") % 5).cast("int")))
    return views.table(s, d, "part").select(line.alias("value")).where(~F.col("value").rlike("TYPE=[DI][UNE][PVL]"))


@query
def reciprocal_overlap_merge(s, d):
    return variants.merge_overlapping(_svs(s, d), 2_000)


@query
def sv_population_frequency(s, d):
    rows = _svs(s, d)
    database = _svs(s, d, 25).where("p_size % 3 = 0").select("id", "chr", "start", "end", "svtype", F.col("p_size").cast("long").alias("ac"), (F.col("p_size") / F.lit(100.0)).alias("af"))
    return variants.population_frequency(rows.where("p_size % 3 != 0").drop("p_size"), database, 2_000)


@query
def unified_caller_segments(s, d):
    """Three callers' changed segments as disjoint pieces with the callers that support each."""
    part = views.table(s, d, "part")
    n = F.col("p_partkey")
    start = n % 200 * 50
    calls = part.select(
        F.col("p_brand").alias("chr"), F.when(F.col("p_size") % 2 == 0, "DEL").otherwise("DUP").alias("svtype"), F.element_at(F.array(*map(F.lit, ("alpha", "beta", "gamma"))), (1 + n % 3).cast("int")).alias("caller"),
        start.alias("start"), (start + F.col("p_size") * 20).alias("end"), (F.col("p_size") % 12).alias("cn"), F.when(n % 3 == 0, n % 60).alias("probes"), (n % 9).alias("weight"), F.when(n % 3 == 1, n % 10).alias("norm_weight"),
    )
    return variants.unified_segments(variants.unified_calls(calls))


@query
def multi_caller_regions(s, d):
    panel = _svs(s, d, 25).join(views.table(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("region_name")), "id")
    return variants.callers_by_region(_svs(s, d).where("p_size % 3 != 0").select("id", "chr", "start", "end"), panel.where("p_size % 3 = 0").select("chr", "start", "end", "region_name"), 2_000)


@query
def genotype_class_posterior(s, d):
    rows = _alleles(s, d).withColumn("pop_het", 2 * F.col("baf") * (1 - F.col("baf")))
    columns = ("vaf", "hom_prob", "het_prob", "tri_prob", "quad_prob")
    return rounded(variants.genotype_classes(rows).select("sample", "site", *columns), *columns)


@query
def transition_cost_table(s, d):
    """What each change of state costs over each distance between neighbouring regions of the panel."""
    m, p = transitions(), prior()
    states = [F.struct(F.lit(a).alias("source"), F.lit(b).alias("target"), F.lit(float(m[i, j])).alias("p"), F.lit(float(p[j])).alias("prior")) for i, a in enumerate(STATES) for j, b in enumerate(STATES)]
    far = intervals.distances(views.panel(s, d)).where("dist is not null").select("dist").distinct()
    t = 1 - logistic(F.col("dist").cast("double"), DISTANCE, DISTANCE_SCALE)
    costs = far.select("dist", t.alias("t"), F.inline(F.array(*states))).withColumn("cost", -F.ln(F.col("t") * F.col("p") + (1 - F.col("t")) * F.col("prior")))
    return rounded(costs.select("dist", "source", "target", "p", "cost"), "p", "cost")


@query
def axis_percentile(s, d):
    """The int(0.99 n)-th smallest deviation from 2 copies, at least 0 and at least 15, rounded up."""
    return segments.axis_limits(variants.segment_copy_numbers(views.segments(s, d)))


@query
def viterbi_decode(s, d):
    return rounded(hmm.decode(_nb(s, d)), "chr_cost", digits=4)


@query
def nb_fit(s, d):
    size, mean, n = fit.trimmed_fit(views.coverage(s, d), "cov_raw")
    return rounded(s.createDataFrame([(size, mean, n)], "size double, mean double, n_used long"), "size", "mean", digits=4)


@query
def fisher_strand_bias(s, d):
    i = views.table(s, d, "lineitem")
    counts = [(F.rint("l_quantity").cast("long") % 13).alias("rfwd"), (F.col("l_partkey") % 11).alias("rrev"), F.col("l_linenumber").cast("long").alias("vfwd"), (F.col("l_suppkey") % 7).alias("vrev")]
    found = fit.strand_bias(i.select("l_orderkey", *counts), "l_orderkey")
    return found.withColumn("odds_ratio", F.when(~F.isnan("odds_ratio"), F.col("odds_ratio")))


@query
def purity_mixture(s, d):
    return rounded(fit.purity_prior(_plain(s, d)), "score", digits=4)


@query
def greedy_region_groups(s, d):
    return intervals.greedy_groups(views.panel(s, d), 100_000)


@query
def interval_fusion(s, d):
    return intervals.fuse(views.coverage(s, d), F.expr("start div 86400 div 3"))


@query
def cohort_region_join(s, d):
    regions = views.bins(s, d).where("start div 86400 % 4 != 0").withColumn("region_name", F.concat("chr", F.lit("_"), F.col("start").cast("string")))
    twice = regions.withColumn("region_id", F.col("start") + 1).unionByName(regions.withColumn("region_id", F.col("start") + 2))
    return intervals.at_known_regions(views.coverage(s, d), twice).select("sample", "chr", "start", "region_name", "region_id", "cov_raw")


@query
def nb_copy_states(s, d):
    own = Window.partitionBy("sample")
    rows = _plain(s, d).withColumn("m", F.avg("cov").over(own)).withColumn("v", F.var_samp("cov").over(own))
    rows = likelihood.nb_copy_states(rows, F.col("m"), F.col("m") * F.col("m") / F.greatest(F.col("v") - F.col("m"), F.lit(1e-6) * F.col("m")))
    return rounded(rows.select("sample", "chr", "start", F.posexplode("probabilities").alias("copies", "p")), "p")


@query
def sample_path_cost(s, d):
    return rounded(likelihood.path_cost(_nb(s, d)), "cost", digits=4)


@query
def outlier_regions(s, d):
    return fit.outlier_regions(views.coverage(s, d), "cov_raw", 0.1).select("sample", "chr", "start", "cov_raw", "outlier")


def _shown(called):
    rows = called.segments.select("sample", "chr", "cn_pred", "start", "end", "length", "n_regions", "median_cov", "median_sd_distance")
    return rounded(rows, "median_cov", "median_sd_distance", digits=4)


def _planted(s, d):
    """Coverage with a level of 2000, twice as high in ten bins of one sample and half as high in ten of another."""
    bin_, level = F.expr("start div 86400"), F.col("cov_raw") + 2000
    doubled = (F.col("sample") == "s3") & (F.col("chr") == "view") & bin_.between(10, 19)
    halved = (F.col("sample") == "s7") & (F.col("chr") == "click") & bin_.between(3, 12)
    return views.coverage(s, d).select("sample", "chr", "start", "end", F.when(doubled, level * 2).when(halved, F.floor(level / 2)).otherwise(level).cast("long").alias("cov_raw"))


@query
def cnv_caller_end_to_end(s, d):
    """Germline calls of a panel: similar samples' moments, normal tails, the decoder, recurrence."""
    return _shown(call(_planted(s, d), CallerConfig(least_correlation=-1.0, most_in_cohort=0.9)))


@query
def cnv_caller_somatic(s, d):
    """Tumour calls with sites, three rounds of decoding and purity."""
    sites = _alleles(s, d).select("sample", "chr", "pos", "alt_count", "ref_count", (2 * F.col("baf") * (1 - F.col("baf"))).alias("pop_het"))
    return _shown(call(_planted(s, d), CallerConfig(calling="tumor_only", least_correlation=-1.0), sites=sites))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return {name: sql for name, sql in oracles.SQL.items() if name in QUERIES}
