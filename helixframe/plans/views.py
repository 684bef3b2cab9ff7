"""Projections of the driver's tables into the genomic domain, as DataFrames and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BIN = 86400
BINS_PER_CHR = 30
CHROMOSOMES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads at a position: event types are chromosomes, seconds since 2024 positions, users samples."""
    pos = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    sample = F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("chr"), pos.alias("pos"), sample.alias("sample"), "value")


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    chrs = table(spark, sf_dir, "events").select(F.col("event_type").alias("chr")).distinct()
    return chrs.select("chr", F.explode(F.sequence(F.lit(0), F.lit(BINS_PER_CHR - 1))).alias("bin")).select("chr", (F.col("bin").cast("long") * BIN).alias("start"), (F.col("bin").cast("long") * BIN + BIN - 1).alias("end"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, chr, start, end, n_reads, cov_raw) of every sample and bin, zero where nothing was read."""
    from helixframe.operators.intervals import binned_depth

    return binned_depth(reads(spark, sf_dir), bins(spark, sf_dir), BIN)


def pile(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.substring(F.lit("ACGT"), 1 + F.col("l_linenumber") % 4, F.lit(1))
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), (F.col("l_suppkey") % 10).cast("string")).alias("sample"), F.col("l_partkey").alias("site"), base.alias("base"), "l_quantity")
    return rows.groupBy("sample", "site", "base").agg(F.sum("l_quantity").alias("n"))


def snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    chrs = F.array(*map(F.lit, CHROMOSOMES))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("site"), F.element_at(chrs, (1 + F.col("p_partkey") % 5).cast("int")).alias("chr"),
        (F.col("p_partkey") * 1297 % 2592000).alias("pos"), F.substring(F.lit("ACGT"), 1 + F.col("p_size") % 4, F.lit(1)).alias("alt"), (F.col("p_size") / F.lit(51.0)).alias("baf"),
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("p_partkey") * 1000
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("chr"), start.alias("start"), (start + F.col("p_size") * 100).alias("end"), F.col("p_name").alias("region_name"), F.col("p_partkey").alias("ordinal"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, log2 = F.col("o_orderkey") * 1000, F.col("o_totalprice") / 250000 - 1
    # What is rounded to 0 from below keeps its sign, which Spark drops and text shows.
    rounded = F.when((log2 < 0) & (F.round(log2, 6) == 0), F.lit(-0.0)).otherwise(F.round(log2, 6))
    return table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("contig"), start.alias("start"), (start + 999).alias("end"), rounded.alias("log2"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage with a copy number by rounding twice the ratio to the sample's mean, at most 5."""
    from pyspark.sql import Window

    mean = F.avg("cov_raw").over(Window.partitionBy("sample"))
    state = F.least(F.lit(5), F.floor(2 * F.col("cov_raw") / mean + 0.5)).cast("int").cast("string")
    return coverage(spark, sf_dir).withColumn("cn_pred", state).withColumn("cov", F.col("cov_raw").cast("double"))


SQL = {
    "g_reads": "SELECT event_id, event_type AS chr, (epoch_us(ts) // 1000000) - 1704067200 AS pos, 's' || (user_id % 10)::VARCHAR AS sample, value FROM events",
    "g_bins": "SELECT chr, b * 86400 AS start, b * 86400 + 86399 AS \"end\" FROM (SELECT DISTINCT event_type AS chr FROM events), range(30) t(b)",
    "g_cov": """SELECT s.sample, b.chr, b.start, b."end", count(r.event_id) AS n_reads, coalesce(sum(floor(r.value)), 0)::BIGINT AS cov_raw
      FROM g_bins b CROSS JOIN (SELECT DISTINCT sample FROM g_reads) s LEFT JOIN g_reads r ON r.chr = b.chr AND r.sample = s.sample AND r.pos // 86400 = b.start // 86400 GROUP BY ALL""",
    "g_pile": "SELECT 's' || (l_suppkey % 10)::VARCHAR AS sample, l_partkey AS site, substr('ACGT', (1 + l_linenumber % 4)::INT, 1) AS base, sum(l_quantity) AS n FROM lineitem GROUP BY ALL",
    "g_snps": "SELECT p_partkey AS site, list_extract(['click','error','purchase','signup','view'], (1 + p_partkey % 5)::INT) AS chr, (p_partkey * 1297) % 2592000 AS pos, substr('ACGT', (1 + p_size % 4)::INT, 1) AS alt, p_size / 51.0::DOUBLE AS baf FROM part",
    "g_panel": "SELECT p_brand AS chr, p_partkey * 1000 AS start, p_partkey * 1000 + p_size * 100 AS \"end\", p_name AS region_name, p_partkey AS ordinal FROM part",
    "g_seg": "SELECT o_orderstatus AS contig, o_orderkey * 1000 AS start, o_orderkey * 1000 + 999 AS \"end\", round(o_totalprice / 250000 - 1, 6) AS log2 FROM orders",
    "g_calls": """SELECT *, least(5, floor(2 * cov_raw / avg(cov_raw) OVER (PARTITION BY sample) + 0.5)::INT)::VARCHAR AS cn_pred, cov_raw::DOUBLE AS cov FROM g_cov""",
}

_NEEDS = {"g_cov": ["g_reads", "g_bins"], "g_calls": ["g_reads", "g_bins", "g_cov"]}


def with_views(*names: str) -> str:
    """WITH clauses, without the comma at the end, that define the views and what they need."""
    order = []
    for name in names:
        order += [x for x in (*_NEEDS.get(name, []), name) if x not in order]
    return "WITH " + ", ".join(f"{name} AS ({SQL[name]})" for name in order)
