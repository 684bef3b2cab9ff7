"""Readers of the tab-separated exchange tables. Every reader returns a DataFrame with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tsv(spark: SparkSession, path, schema: str, header: bool = False) -> DataFrame:
    """One or several files or globs; columns by position, extra columns on the right are left out."""
    return spark.read.csv(path, sep="\t", schema=schema, header=header, enforceSchema=True)


def sample_of(pattern: str, group: int = 1) -> Column:
    """The sample's name from the path of the file that a row comes from."""
    return F.regexp_extract("_metadata.file_path", pattern, group)


def tagged_tsv(spark: SparkSession, path, schema: str, pattern: str, header: bool = False, suffix: str = "") -> DataFrame:
    """Many files in one scan with a ``sample`` column from their paths. Empty files give no rows."""
    return tsv(spark, path, schema, header).select("*", F.concat(sample_of(pattern), F.lit(suffix)).alias("sample"))


def sequence_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(chr, chr_size, chr_place) of the @SQ lines; chr_place grows in the file's order."""
    lines = spark.read.text(path).withColumn("chr_place", F.monotonically_increasing_id()).where(F.col("value").startswith("@SQ"))
    return lines.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chr"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("chr_size"), "chr_place")


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample_name, donor, tumor_normal) of a run's JSON configuration, whose ``samples`` map ids to samples; missing fields are null."""
    fields = "sample_name string, donor string, tumor_normal string"
    found = spark.read.text(path, wholetext=True).select(F.from_json("value", f"samples map<string, struct<{fields.replace(' string', ': string')}>>").alias("run"))
    return found.select(F.explode("run.samples").alias("id", "s")).select("s.sample_name", "s.donor", "s.tumor_normal")


def snp_path(coverage_path: Column) -> Column:
    """Where the allele counts that belong to a coverage file are."""
    return F.regexp_replace(coverage_path, r"\.region_coverage\.tsv", ".snpAF.tsv")


def cohort_table(spark: SparkSession, path: str) -> DataFrame:
    """An earlier cohort's rows, from a folder of Parquet or a TSV with a header; chromosomes and samples are texts."""
    if path.endswith((".tsv", ".csv", ".txt")):
        found = spark.read.csv(path, sep="\t", header=True, inferSchema=True)
    else:
        found = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    return found.withColumns({c: F.col(c).cast("string") for c in ("chr", "sample", "cn_pred") if c in found.columns})


def tumour_fractions(spark: SparkSession, path: str | None) -> DataFrame:
    """(sample, pred_tl) of a table that a run may lack: no path, or none that exists, gives no rows."""
    from pyspark.errors import AnalysisException

    none = spark.createDataFrame([], "sample string, pred_tl double")
    if path is None:
        return none
    try:
        found = spark.read.csv(path, sep="\t", header=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return none
    return found.select(F.col("sample").cast("string"), F.col("pred_TL").cast("double").alias("pred_tl"))


def vcf(spark: SparkSession, path) -> DataFrame:
    """(chr, pos, id, ref, alt, qual, filter, info, sample_values, file) of VCF files; info is a map, flags are "".

    sample_values is an array, in the order of the files' samples, of maps from FORMAT keys to values.
    """
    c = F.split("value", "\t")
    rows = spark.read.text(path).select(c.alias("c"), F.col("_metadata.file_path").alias("file")).where(~F.col("value").startswith("#") & (F.size("c") >= 8))
    at = lambda i: F.get("c", F.lit(i))
    entries = F.transform(F.split(at(7), ";"), lambda x: F.struct(F.split_part(x, F.lit("="), F.lit(1)).alias("k"), F.substring_index(F.concat(x, F.lit("=")), "=", 2).alias("kv")))
    info = F.map_from_entries(F.transform(F.array_distinct(F.transform(entries, lambda e: e["k"])), lambda k: F.struct(k, F.array_max(F.transform(F.filter(entries, lambda e: e["k"] == k), lambda e: F.split_part(e["kv"], F.lit("="), F.lit(2)))))))
    keys = F.split(at(8), ":")
    samples = F.when(F.size("c") > 9, F.transform(F.slice("c", 10, F.size("c")), lambda s: F.map_from_entries(F.filter(F.arrays_zip(keys.alias("k"), F.split(s, ":").alias("v")), lambda e: e["k"].isNotNull()))))
    return rows.select(
        at(0).alias("chr"), at(1).cast("long").alias("pos"), at(2).alias("id"), at(3).alias("ref"), at(4).alias("alt"), F.expr("try_cast(get(c, 5) as double)").alias("qual"), at(6).alias("filter"), info.alias("info"), samples.alias("sample_values"), "file",
    )


def structural_calls(records: DataFrame) -> DataFrame:
    """(id, chr, start, end, svtype, filter) of ``vcf`` records of structural callers.

    The type is SVTYPE, or the symbol of ALT; the end is END, or the start and the length where
    there is one. Breakends (type BND), whose other end is on another line, end where they start.
    """
    kind = F.coalesce(F.col("info")["SVTYPE"], F.nullif(F.regexp_extract("alt", "^<([A-Z]+)", 1), F.lit("")))
    length = F.abs(F.col("info")["SVLEN"].try_cast("long"))
    end = F.when(kind == "BND", F.col("pos")).otherwise(F.coalesce(F.col("info")["END"].try_cast("long"), F.col("pos") + length, F.col("pos")))
    return records.select("id", "chr", F.col("pos").alias("start"), F.greatest(end, F.col("pos")).alias("end"), kind.alias("svtype"), "filter")


def region_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chr, start, end, region_name, ordinal): up to four columns; names are synthesised where missing."""
    raw = spark.read.text(path).select(F.split("value", "\t").alias("c"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ordinal"))
    part = lambda i: F.get("c", F.lit(i))
    name = F.coalesce(part(3), F.concat_ws("_", F.lit("reg"), part(0), part(1), part(2)))
    return raw.where(F.size("c") >= 3).select(part(0).alias("chr"), part(1).cast("long").alias("start"), part(2).cast("long").alias("end"), name.alias("region_name"), "ordinal")


def region_coverage(spark: SparkSession, path, pattern: str) -> DataFrame:
    """(sample, chr, start, end, cov_raw): of any number of columns the last three are dropped, the last left is the depth."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).select(c.alias("c"), sample_of(pattern).alias("sample")).where(F.size("c") >= 7)
    at = lambda i: F.get("c", F.lit(i))
    return rows.select("sample", at(0).alias("chr"), at(1).cast("long").alias("start"), at(2).cast("long").alias("end"), F.get("c", F.size("c") - 4).cast("long").alias("cov_raw"))


def allele_counts(spark: SparkSession, path, pattern: str) -> DataFrame:
    """(chr, pos, A, C, G, T, cov, sample) with a depth."""
    found = tagged_tsv(spark, path, "chr string, pos long, A long, C long, G long, T long, cov long", pattern)
    return found.where("cov > 0")


def panel_snps(spark: SparkSession, path) -> DataFrame:
    found = tsv(spark, path, "chr string, pos long, ref string, alt string, baf double")
    return found.withColumn("pop_het", 2 * F.col("baf") * (1 - F.col("baf")))


def cytobands(spark: SparkSession, path: str) -> DataFrame:
    """(chr, start, end, band_type): the first three columns and the last."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).select(c.alias("c")).where(F.size("c") >= 4)
    return rows.select(F.get("c", F.lit(0)).alias("chr"), F.get("c", F.lit(1)).cast("long").alias("start"), F.get("c", F.lit(2)).cast("long").alias("end"), F.element_at("c", -1).alias("band_type"))


def gc_profile(spark: SparkSession, path, least_usable: float = 0.85) -> DataFrame:
    return tsv(spark, path, "chr string, start long, gc double, usable_bases_ratio double").where(F.col("usable_bases_ratio") > least_usable)


def nucleotide_table(spark: SparkSession, path: str) -> DataFrame:
    """(chr, start, gc, usable) of a table with a header that names shares of AT and GC."""
    found = spark.read.csv(path, sep="\t", header=True)
    by_name = lambda part: next(c for c in found.columns if part in c)
    gc, at = F.col(f"`{by_name('pct_gc')}`").cast("double"), F.col(f"`{by_name('pct_at')}`").cast("double")
    usable = F.round(gc + at, 5)
    return found.select(F.col(f"`{found.columns[0]}`").alias("chr"), F.col(f"`{found.columns[1]}`").cast("long").alias("start"), F.when(usable == 0, -1.0).otherwise(gc).alias("gc"), usable.alias("usable"))


def copy_ratio_segments(spark: SparkSession, path) -> DataFrame:
    """(sample, contig, start, end, n_probes, n_baf_probes, log2, baf) of .seg files; the sample is in their @RG lines."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    names = lines.where(F.col("value").startswith("@RG")).groupBy("file").agg(F.min(F.regexp_extract("value", r"\tSM:([^\t]+)", 1)).alias("sample"))
    c = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("@") & ~F.col("value").startswith("CONTIG")).select("file", c.alias("c")).where(F.size("c") >= 10)
    at = lambda i, kind: F.get("c", F.lit(i)).cast(kind)
    found = rows.select("file", at(0, "string").alias("contig"), at(1, "long").alias("start"), at(2, "long").alias("end"), at(3, "long").alias("n_probes"), at(4, "long").alias("n_baf_probes"), at(6, "double").alias("log2"), at(9, "double").alias("baf"))
    return found.join(F.broadcast(names), "file", "left").drop("file")  # one name for each file


def copy_number_segments(spark: SparkSession, path) -> DataFrame:
    """(contig, start, end, log2, baf, depth, n_probes) of .cns files with a header; baf is null where the file has none."""
    found = spark.read.csv(path, sep="\t", header=True)
    baf = F.expr("try_cast(baf as double)") if "baf" in found.columns else F.lit(None).cast("double")
    return found.select(F.col("chromosome").alias("contig"), F.col("start").cast("long"), F.col("end").cast("long"), F.col("log2").cast("double"), baf.alias("baf"), F.col("depth").cast("double"), F.col("probes").cast("long").alias("n_probes"))


#: Positional columns of the small-variant stream, fixed values.
VARIANT_COLUMNS = (
    "sample gene chr start end ref alt dp vd rfwd rrev vfwd vrev genotype af bias pmean pstd qual qstd sbf oddratio mapq sn hiaf adjaf "
    "shift3 msi msilen nm hicnt hicov lseq rseq seg type gamp tamp ncamp ampflag"
).split()
_WHOLE = set("start end dp vd rfwd rrev vfwd vrev shift3 hicnt hicov".split())
_TEXT = set("sample gene chr ref alt genotype bias lseq rseq seg type gamp tamp ncamp ampflag".split())


def small_variants(spark: SparkSession, path) -> DataFrame:
    """Rows of 36 to 40 columns; lines of the statistics package's warnings are skipped.

    gamp, tamp and ncamp are text: counts of amplicons, or for whole genomes and exomes a duplication
    rate, "split reads-spanning pairs-cluster" and reads of genome editing.
    """
    c = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").contains("R_HOME")).select(c.alias("c")).where(F.size("c") >= 36)
    kind = lambda n: "string" if n in _TEXT else "long" if n in _WHOLE else "double"
    return rows.select(*[F.expr(f"try_cast(get(c, {i}) as {kind(n)})").alias(n) for i, n in enumerate(VARIANT_COLUMNS)])


def insert_size(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(file, mean_insert_size): of the rows with exactly 23 fields the first is the header, the second the values.

    A file without such rows or without the column is an error, or, if not ``strict``, gives no row.
    """
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", "\r?\n").alias("lines"))
    wide = rows.withColumn("wide", F.filter("lines", lambda x: F.size(F.split(x, "\t")) == 23))
    pairs = F.map_from_arrays(F.split(F.get("wide", F.lit(0)), "\t"), F.split(F.get("wide", F.lit(1)), "\t"))
    value = F.when(F.size("wide") >= 2, F.try_element_at(pairs, F.lit("MEAN_INSERT_SIZE")))
    if strict:
        missing = F.raise_error(F.concat(F.lit("no MEAN_INSERT_SIZE in "), F.col("file"))).cast("string")
        return wide.select("file", F.coalesce(value, missing).alias("mean_insert_size"))
    return wide.select("file", value.alias("mean_insert_size")).where("mean_insert_size is not null")


def freec_calls(spark: SparkSession, path, pattern: str) -> DataFrame:
    return tagged_tsv(spark, path, "chr string, start long, end long, copy_number int, kind string", pattern)


def event_kind(path: Column) -> Column:
    """The kind of event that a caller's per-kind output file holds, from its suffix; null for other files."""
    found = F.regexp_extract(path, r"_(BP|CloseEndMapped|D|INT_final|INV|LI|RP|SI|TD)$", 1)
    return F.when(found != "", found)
