"""Writers of the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.genome import bare_name, chr_rank
from helixframe.operators.variants import vcf_header


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.option("sep", "\t").option("header", header).csv(path)


def write_bed(df: DataFrame, path: str) -> None:
    """Without a header, whole numbers in full."""
    write_tsv(df.select(*[F.col(c).cast("string") for c in df.columns]), path, header=False)


def write_by_sample(df: DataFrame, path: str) -> None:
    df.write.partitionBy("sample").option("sep", "\t").option("header", True).csv(path)


def write_vcf(lines: DataFrame, sample: str, path: str, header: list | None = None) -> None:
    """Data lines as VCF parts in ``path``/data, in the chromosomes' natural order, and the header in ``path``/header, to be read or joined in that order."""
    spark = lines.sparkSession
    head = [*(header or vcf_header()), "\t".join(("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample))]
    spark.createDataFrame([("\n".join(head),)], "value string").write.text(f"{path}/header")
    chromosome = F.split_part("value", F.lit("\t"), F.lit(1))
    order = [chr_rank(chromosome), bare_name(chromosome), F.split_part("value", F.lit("\t"), F.lit(2)).cast("long"), F.col("value")]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).write.text(f"{path}/data")


def append_cohort(coverage: DataFrame, path: str) -> None:
    """Add a batch's samples to the cohort's store, a folder of Parquet for each sample; samples that it has are replaced."""
    coverage.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sample").parquet(path)


def drop_typed(lines: DataFrame) -> DataFrame:
    """VCF lines that are of no type DUP, INV or DEL."""
    return lines.where(~F.col("value").rlike("TYPE=[DI][UNE][PVL]"))


def caller_config(bams: DataFrame, sizes: DataFrame) -> DataFrame:
    """(value) one line of BAM path, insert size and sample for each BAM (sample, bam) with a size (sample, mean_insert_size)."""
    return bams.join(sizes, "sample").select(F.concat_ws("\t", "bam", "mean_insert_size", "sample").alias("value"))
