"""Depth of fixed-width bins from a stream of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def binned_depth_stream(reads: DataFrame, width: int, lateness: str = "1 hour") -> DataFrame:
    """Running (sample, chr, start, n_reads, cov_raw) of reads (event_id, ts, sample, chr, pos, value).

    A read that arrives again within ``lateness`` of event time counts once; state older than that is
    dropped for repeats, and one row is held for each sample and bin. Write in update or complete mode.
    """
    fresh = reads.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])
    start = F.expr(f"pos div {width}") * width
    return fresh.groupBy("sample", "chr", start.alias("start")).agg(F.count("*").alias("n_reads"), F.sum(F.floor("value")).alias("cov_raw"))
