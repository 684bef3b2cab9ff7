"""Genomic intervals: bins, depth, overlap joins, trimming, gaps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.genome import autosome

from . import ranges
from .shared import materialize


def genome_bins(sizes: DataFrame, width: int, overlap: int = 0) -> DataFrame:
    """(chr, start, end, ordinal) windows of ``width`` over (chr, chr_size), which begin ``overlap`` before the end of the one before.

    The last window of a chromosome ends at its size, so a larger size that is a multiple of the
    width gives a window of one position; chromosomes no longer than a window are one that ends
    before their size. Where the sizes have a place in their dictionary, chr_place keeps it.
    """
    large = F.col("chr_size") > width
    count = F.when(large, F.expr(f"chr_size div {width}")).otherwise(0).cast("long")
    bins = sizes.withColumn("last", count).withColumn("ordinal", F.explode(F.sequence(F.lit(0).cast("long"), count)))
    start = F.col("ordinal") * width - F.when(F.col("ordinal") > 0, overlap).otherwise(0)
    end = F.when(~large, F.col("chr_size") - 1).when(F.col("ordinal") == F.col("last"), F.col("chr_size")).otherwise((F.col("ordinal") + 1) * width - 1)
    place = ["chr_place"] if "chr_place" in sizes.columns else []
    return bins.select("chr", start.cast("long").alias("start"), end.alias("end"), "ordinal", *place)


def dictionary_order(regions: DataFrame, sizes: DataFrame) -> DataFrame:
    """Regions sorted by their chromosomes' places in the dictionary (chr, chr_place), then by position."""
    placed = regions.drop("chr_place").join(sizes.select("chr", "chr_place"), "chr", "left")
    return placed.orderBy(F.col("chr_place").asc_nulls_last(), "chr", "start", "end")


def keep_autosomes(rows: DataFrame, column: str = "chr", count: int = 22) -> DataFrame:
    """Rows on numbered chromosomes."""
    return rows.where(autosome(F.col(column), count))


def keep_wide_bins(bins: DataFrame) -> DataFrame:
    """Bins wider than half the widest one."""
    widest = bins.agg(F.max(F.col("end") - F.col("start")).alias("widest"))
    return bins.join(F.broadcast(widest)).where((F.col("end") - F.col("start")) > F.col("widest") / 2).drop("widest")


def binned_depth(reads: DataFrame, bins: DataFrame, width: int) -> DataFrame:
    """Reads and the sum of their whole values per sample and fixed-width bin, zero where there are none.

    A read's bin follows from its position, so reads are combined before they are shuffled.
    """
    at = F.expr(f"pos div {width}") * width
    counted = reads.groupBy("sample", "chr", at.alias("start")).agg(F.count("event_id").alias("n_reads"), F.sum(F.floor("value")).alias("cov_raw"))
    # One row for each sample: the reads' samples, combined before they are shuffled.
    grid = bins.join(F.broadcast(reads.select("sample").distinct()))
    zero = F.lit(0).cast("long")
    return grid.join(counted, ["sample", "chr", "start"], "left").select("sample", "chr", "start", "end", F.coalesce("n_reads", zero).alias("n_reads"), F.coalesce("cov_raw", zero).alias("cov_raw"))


def region_depth(reads: DataFrame, regions: DataFrame, width: int = 100_000) -> DataFrame:
    """(sample, chr, start, end, n_reads): reads (sample, chr, start, end) that overlap each region of any list, zero where none does.

    A region that occurs twice is counted once; reads are combined by region before the zeros join.
    """
    distinct = regions.select("chr", "start", "end").distinct()
    met = overlaps(reads.select("sample", "chr", "start", "end"), distinct, width)
    counted = met.groupBy(F.col("a_sample").alias("sample"), F.col("b_chr").alias("chr"), F.col("b_start").alias("start"), F.col("b_end").alias("end")).agg(F.count("*").alias("n_reads"))
    # Every region for every sample; samples are one row each, and without the hint Spark may pair all partitions of both tables.
    grid = distinct.crossJoin(F.broadcast(reads.select("sample").distinct()))
    return grid.join(counted, ["sample", "chr", "start", "end"], "left").select("sample", "chr", "start", "end", F.coalesce("n_reads", F.lit(0).cast("long")).alias("n_reads"))


#: Each level of cuts is so many times as wide as the one below; the widest cut holds a whole chromosome.
LEVEL_FACTOR, WIDEST = 8, 1 << 32


#: The same for points, which are looked up at every level.
POINT_FACTOR = 64


def points_in_regions(points: DataFrame, regions: DataFrame, width: int, pos: str = "pos") -> DataFrame:
    """Inner join of (chr, pos) with the (chr, start, end) that hold it, ends included.

    A region lies in one or two cuts of the narrowest level that holds its length, whatever that is
    (``width`` is the narrowest cut), and a point in one cut of every level: an equi-join on chromosome,
    level and cut.
    """
    widths = [width]
    while widths[-1] < WIDEST:
        widths.append(widths[-1] * POINT_FACTOR)
    cut = lambda x, w: F.floor(F.col(x) / w).cast("long")
    at = lambda level, x, w: F.struct(F.lit(level).alias("__at"), cut(x, w).alias("__cut"))
    own = F.array_distinct(F.array(at(len(widths) - 1, "start", widths[-1]), at(len(widths) - 1, "end", widths[-1])))
    for i in reversed(range(len(widths) - 1)):
        own = F.when(F.col("end") - F.col("start") < widths[i], F.array_distinct(F.array(at(i, "start", widths[i]), at(i, "end", widths[i])))).otherwise(own)
    placed = points.select("*", F.inline(F.array(*[at(i, pos, w) for i, w in enumerate(widths)])))
    met = placed.join(regions.select("*", F.inline(own)), ["chr", "__at", "__cut"])
    return met.where((F.col(pos) >= F.col("start")) & (F.col(pos) <= F.col("end"))).drop("__at", "__cut")


def _widths(width: int) -> list[int]:
    widths = [width]
    while widths[-1] < WIDEST:
        widths.append(widths[-1] * LEVEL_FACTOR)
    return widths


def _level(prefix: str, width: int) -> Column:
    """The level of the narrowest cuts that hold an interval's length."""
    widths = _widths(width)
    level = F.lit(len(widths) - 1)
    for i in reversed(range(len(widths) - 1)):
        level = F.when(F.col(f"{prefix}_end") - F.col(f"{prefix}_start") < widths[i], i).otherwise(level)
    return level


def _cuts(rows: DataFrame, prefix: str, width: int, met: DataFrame | None = None) -> DataFrame:
    """Rows with __own, the level of the narrowest cuts that hold their length, and a row for each (__at, __cut) of that and wider levels.

    Of the wider levels only those in ``met``, one row with an array of them, if it is given.
    """
    start, end = F.col(f"{prefix}_start"), F.col(f"{prefix}_end")
    div = lambda x, w: F.floor(x / w).cast("long")
    wanted = lambda i: F.lit(True) if met is None else (F.col("__own") == i) | F.array_contains("__met", i)
    at = [F.when((F.col("__own") <= i) & wanted(i), F.array_distinct(F.array(*[F.struct(F.lit(i).alias("__at"), div(x, w).alias("__cut")) for x in (start, end)]))) for i, w in enumerate(_widths(width))]
    placed = rows.withColumn("__own", _level(prefix, width))
    placed = placed if met is None else placed.crossJoin(F.broadcast(met))
    return placed.select("*", F.inline(F.flatten(F.array_compact(F.array(*at))))).drop("__met")


def overlaps(a: DataFrame, b: DataFrame, width: int, chr_a: str = "chr", chr_b: str = "chr") -> DataFrame:
    """Pairs of intervals that share a position: columns of ``a`` with prefix a_, of ``b`` with b_.

    An interval lies in one or two cuts of the narrowest level that holds its length, and meets
    longer ones at their level, so it has a few rows whatever its length (``width`` is the
    narrowest cut). The join is an equi-join on chromosome, level, cut and which of the two is longer,
    so a pair meets only at the level of the longer interval, and is kept in the first cut that both have.
    """
    levels = lambda rows, prefix: rows.agg(F.collect_set(_level(prefix, width)).alias("__met"))
    left, right = (df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns]) for df, p in ((a, "a"), (b, "b")))
    # Of b longer: a at the wider levels, b at its own. Else: a at its own, b there and at the wider ones.
    at_left = _cuts(left, "a", width, levels(right, "b")).withColumn("__longer", F.col("__at") > F.col("__own"))
    sides = F.when(F.col("__at") == F.col("__own"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    at_right = _cuts(right, "b", width, levels(left, "a")).withColumn("__longer", F.explode(sides))
    met = at_left.drop("__own").withColumn("__chr", F.col(f"a_{chr_a}")).join(at_right.drop("__own").withColumn("__chr", F.col(f"b_{chr_b}")), ["__chr", "__at", "__cut", "__longer"])
    wide = F.lit(float(width)) * F.pow(F.lit(float(LEVEL_FACTOR)), F.col("__at"))
    first = F.floor(F.greatest("a_start", "b_start") / wide) == F.col("__cut")
    return met.where((F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & first).drop("__chr", "__at", "__cut", "__longer")


def shared_length() -> Column:
    return F.least("a_end", "b_end") - F.greatest("a_start", "b_start") + 1


def reciprocal_overlap(share: float) -> Column:
    """Whether a pair of ``overlaps`` shares so much of either interval."""
    return (shared_length() >= share * (F.col("a_end") - F.col("a_start") + 1)) & (shared_length() >= share * (F.col("b_end") - F.col("b_start") + 1))


def _reciprocal_keys(rows: DataFrame, prefix: str, share: float, wide: bool) -> DataFrame:
    """Rows with the keys (__at, __cut, __longer) at which pairs of a ``share`` meet: of one row for each key on one side and three neighbours on the ``wide`` side."""
    start, end = F.col(f"{prefix}_start"), F.col(f"{prefix}_end")
    # Lengths of such a pair are in one class or in neighbouring ones, a little wider than the share asks.
    ratio = max(1.01 / share, 1.5)
    own = F.floor(F.log((end - start + 1).cast("double")) / math.log(ratio)).cast("int")
    # Starts of such a pair are no farther apart than the part of the longer one that is not shared.
    reach = lambda level: F.pow(F.lit(ratio), level + 1) * max(1 - share, 0.0) + 1
    steps = (-1, 0, 1) if wide else (0,)
    key = lambda level, longer: [F.struct(level.alias("__at"), (F.floor(start / reach(level)) + i).cast("long").alias("__cut"), F.lit(longer).alias("__longer")) for i in steps]
    at = F.col("__own")
    # Of b in the higher class: a at the class above its own, b at its own. Else: a at its own, b at its own and above.
    keys = [*key(at, False), *key(at, True), *key(at + 1, False)] if wide else [*key(at, False), *key(at + 1, True)]
    return rows.where(start <= end).withColumn("__own", own).select("*", F.inline(F.array(*keys))).drop("__own")


def reciprocal_neighbours(rows: DataFrame, share: float, by: tuple = ("chr",)) -> DataFrame:
    """Some of the pairs of ``reciprocal_pairs`` of a table with itself: each row with those before it by start, and by length, among the rows that meet at a key."""
    b = rows.select(*[F.col(c).alias(f"b_{c}") for c in rows.columns])
    keyed = _reciprocal_keys(b, "b", share, False).where(~F.col("__longer"))
    keys = [*[f"b_{c}" for c in by], "__at", "__cut"]
    length = F.col("b_end") - F.col("b_start")
    before = lambda *order: F.lag(F.struct(*[F.col(f"b_{c}").alias(f"a_{c}") for c in rows.columns])).over(Window.partitionBy(*keys).orderBy(*order))
    lagged = keyed.withColumns({"__by_start": before("b_start", "b_end"), "__by_length": before(length, "b_start")})
    found = lagged.select(*b.columns, F.explode(F.array("__by_start", "__by_length")).alias("__a")).select(*b.columns, "__a.*")
    return found.where((F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & reciprocal_overlap(share))


def reciprocal_pairs(a: DataFrame, b: DataFrame, share: float, by: tuple = ("chr",), group: str | None = None) -> DataFrame:
    """Pairs of intervals, equal in ``by``, that share a ``share`` (above 0) of either: columns of ``a`` with prefix a_, of ``b`` with b_.

    An equi-join on classes of length and on cuts as wide as the starts may differ. If ``group`` names a
    column of both, pairs of one group are left out, and cuts that hold one group only are not joined.
    """
    left, right = (df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns], *[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)]) for df, p in ((a, "a"), (b, "b")))
    left, right = _reciprocal_keys(left, "a", share, False), _reciprocal_keys(right, "b", share, True)
    keys = [*[f"__by{i}" for i in range(len(by))], "__at", "__cut", "__longer"]
    if group:
        ends = lambda df, p: df.groupBy(*keys).agg(F.min(f"{p}_{group}").alias(f"__{p}_low"), F.max(f"{p}_{group}").alias(f"__{p}_high"))
        mixed = ends(left, "a").join(ends(right, "b"), keys).where((F.col("__a_low") != F.col("__b_high")) | (F.col("__b_low") != F.col("__a_high")))
        mixed = materialize(mixed.select(*keys))
        left, right = left.join(mixed, keys, "left_semi"), right.join(mixed, keys, "left_semi")
    met = left.join(right, keys)
    met = met.where(F.col(f"a_{group}") != F.col(f"b_{group}")) if group else met
    return met.where((F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & reciprocal_overlap(share)).drop(*keys)


def trim_overlaps(regions: DataFrame, by: tuple = ("chr",), least: int = 20) -> DataFrame:
    """Start each region after the end of the one before it; drop what is not longer than ``least``."""
    before = F.lag("end").over(Window.partitionBy(*by).orderBy("start", "end"))
    trimmed = regions.withColumn("start", F.greatest(F.col("start"), F.coalesce(before + 1, F.col("start"))))
    return trimmed.where(F.col("end") - F.col("start") > least)


def distances(regions: DataFrame, by: tuple = ("chr",)) -> DataFrame:
    """``dist``: from the end of the region before, null for the first."""
    return regions.withColumn("dist", F.col("start") - F.lag("end").over(Window.partitionBy(*by).orderBy("start", "end")))


def gaps(regions: DataFrame, longer_than: int) -> DataFrame:
    """(chr, gap_start, gap_end, gap) between consecutive distinct regions."""
    order = Window.partitionBy("chr").orderBy("start", "end")
    found = regions.select("chr", "start", "end").distinct().withColumn("gap_end", F.lead("start").over(order))
    return found.select("chr", F.col("end").alias("gap_start"), "gap_end", (F.col("gap_end") - F.col("end")).alias("gap")).where(F.col("gap") > longer_than)


def numbered(rows: DataFrame, name: str, *order) -> DataFrame:
    """``name``: 1, 2, ... in an order, without bringing all rows to one task.

    Rows are dealt in ranges of the order, written, and numbered within each; the few counts of the
    ranges give each its first number.
    """
    dealt = materialize(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    # One row for each range.
    first = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.withColumn("__in", within).join(F.broadcast(first), "__range").withColumn(name, (F.col("__before") + F.col("__in")).cast("long")).drop("__range", "__before", "__in")


def name_regions(regions: DataFrame) -> DataFrame:
    """Names made unique by a suffix where they repeat, synthesised where null; region_id in file order."""
    name = F.coalesce("region_name", F.concat_ws("_", F.lit("reg"), "chr", "start", "end"))
    named = regions.withColumn("region_name", name)
    same = Window.partitionBy("region_name")
    rank = F.row_number().over(same.orderBy("ordinal"))
    many = F.count("*").over(same) > 1
    unique = F.when(many, F.concat_ws("_", "region_name", rank.cast("string"))).otherwise(F.col("region_name"))
    return numbered(named.withColumn("region_name", unique), "region_id", "ordinal")


def centromeres(bands: DataFrame, pad: float = 0.1) -> DataFrame:
    """(chr, c_start, c_end): extent of the acen bands of a chromosome, padded by a share of its length."""
    extent = bands.where("band_type = 'acen'").groupBy("chr").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    return extent.select("chr", (F.col("a") - pad * (F.col("b") - F.col("a"))).alias("c_start"), (F.col("b") + pad * (F.col("b") - F.col("a"))).alias("c_end"))


def outside_centromeres(coverage: DataFrame, bands: DataFrame, pad: float = 0.1) -> DataFrame:
    """Coverage rows that overlap no padded centromere; there is at most one for each chromosome."""
    c = centromeres(bands, pad).withColumnRenamed("chr", "c_chr")
    hit = (F.col("chr") == F.col("c_chr")) & (F.col("start") <= F.col("c_end")) & (F.col("end") >= F.col("c_start"))
    return coverage.join(c, hit, "left_anti")


def owned_points(points: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """Points in regions, each (chr, pos) once: the smallest region id, then the highest prior, owns it."""
    met = points_in_regions(points, regions, width)
    order = Window.partitionBy("chr", "pos").orderBy("region_id", F.col("pop_het").desc(), "site")
    return met.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def greedy_groups(regions: DataFrame, most: int) -> DataFrame:
    """``group``: regions in order, a group going on while it stays within ``most`` positions of its start.

    A chromosome may lie in many ranges (``ranges.greedy_groups``). Regions without a start or an end
    are of the group before.
    """
    rows = regions.select("chr", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    found = ranges.greedy_groups(rows, ("chr",), ("start", "end"), F.col("start"), F.col("end"), most)
    return found.select("chr", "start", "end", F.col("__group").cast("int").alias("group"))


def fuse(coverage: DataFrame, group) -> DataFrame:
    """Neighbouring regions of a sample with an equal ``group`` (a column) as one, depths summed."""
    fused = coverage.groupBy("sample", "chr", group.alias("group"))
    return fused.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("cov_raw").alias("cov_raw"))


def at_known_regions(coverage: DataFrame, regions: DataFrame) -> DataFrame:
    """Coverage rows of regions that the dictionary has, with the name and id of its first such row."""
    order = Window.partitionBy("chr", "start", "end").orderBy("region_id")
    first = regions.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    return coverage.join(first, ["chr", "start", "end"])
