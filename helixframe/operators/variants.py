"""Segments and small variants: copy numbers, genotypes, filters, structural merges, VCF text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.genome import let

from . import ranges
from .intervals import overlaps, reciprocal_neighbours, reciprocal_overlap, reciprocal_pairs, shared_length
from .shared import materialize


def kind_of(cn: Column, low: float, high: float) -> Column:
    return F.when(cn < low, "DEL").when(cn > high, "DUP").otherwise("COPY_NORMAL")


def segment_copy_numbers(segments: DataFrame, tumour_content: float | None = 0.5, homozygous: float = 0.5, low: float = 1.5, high: float = 2.5) -> DataFrame:
    """``cn`` from log2, ``ccn`` corrected for tumour content; svtype and genotype by limits on cn, which is not corrected.

    Without a tumour content ``ccn`` is the number before it is rounded.
    """
    raw = 2 * F.pow(F.lit(2.0), F.col("log2"))
    ccn = F.bround(2 + (raw - 2) * (1 / tumour_content), 2) if tumour_content else raw
    genotype = F.when(F.col("cn") < homozygous, "1/1").when(F.col("svtype") == "COPY_NORMAL", "0/0").otherwise("0/1")
    return segments.withColumn("cn", F.bround(raw, 2)).withColumn("ccn", ccn).withColumn("svtype", kind_of(F.col("cn"), low, high)).withColumn("gt", genotype)


#: INFO and FORMAT fields of segment VCFs: id, number, type, what it is. Ids are fixed by the format's readers.
SEGMENT_INFO = (
    ("SVTYPE", "1", "String", "DEL, DUP or COPY_NORMAL"),
    ("END", "1", "Integer", "End of the segment"),
    ("SVLEN", "1", "Integer", "Length of the segment"),
    ("LOG_ODDS_RATIO", "1", "Float", "log2 ratio of the segment"),
    ("COPY_NUMBER", "1", "Float", "Copy number"),
    ("CORRECTED_COPY_NUMBER", "1", "Float", "Copy number of the tumour cells"),
    ("PROBES", "1", "Integer", "Probes in the segment"),
    ("BAF", "1", "Float", "Minor allele frequency"),
    ("BAF_PROBES", "1", "Integer", "Sites with an allele frequency"),
)
SEGMENT_FORMAT = (
    ("GT", "1", "String", "Genotype"),
    ("CN", "1", "Float", "Copy number"),
    ("CCN", "1", "Float", "Copy number of the tumour cells"),
    ("CNQ", "1", "Integer", "Probes in the segment"),
    ("DP", "1", "Float", "Depth"),
    ("BAF", "1", "Float", "Minor allele frequency"),
    ("BAFQ", "1", "Integer", "Sites with an allele frequency"),
)


def vcf_header(info: tuple = SEGMENT_INFO, fields: tuple = SEGMENT_FORMAT, version: str = "4.2", filters: tuple = (), date: str | None = None) -> list[str]:
    """Header lines up to the column names; ``date`` is the file's date, today's if none is given."""
    from datetime import date as calendar

    lines = [f"##fileformat=VCFv{version}", f"##fileDate={date or calendar.today().isoformat()}"]
    for kind, rows in (("INFO", info), ("FORMAT", fields)):
        lines += [f'##{kind}=<ID={i},Number={n},Type={t},Description="{d}">' for i, n, t, d in rows]
    return lines + [f'##FILTER=<ID={i},Description="{d}">' for i, d in filters]


def vcf_lines(segments: DataFrame) -> DataFrame:
    """(value) VCF 4.2 data lines of ``segment_copy_numbers`` rows, normal ones included.

    Columns ccn, n_probes, baf, n_baf_probes and depth give their fields where the table has them;
    the allele frequency of a sample is given where it rests on any site.
    """
    has = set(segments.columns)
    number = lambda c: F.format_string("%.2f", c)
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    share = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.format_string("%.6f", c)), F.lit("."))
    info = [("SVTYPE", F.col("svtype")), ("END", whole("end")), ("SVLEN", (F.col("end") - F.col("start") + 1).cast("string")), ("LOG_ODDS_RATIO", F.format_string("%.6f", "log2")), ("COPY_NUMBER", number("cn"))]
    sample = [("GT", F.col("gt")), ("CN", number("cn"))]
    if "ccn" in has:
        info.append(("CORRECTED_COPY_NUMBER", number("ccn")))
        sample.append(("CCN", number("ccn")))
    if "n_probes" in has:
        info.append(("PROBES", whole("n_probes")))
        sample.append(("CNQ", whole("n_probes")))
    if "depth" in has:
        sample.append(("DP", number("depth")))
    form, data = [F.lit(k) for k, _ in sample], [v for _, v in sample]
    if "baf" in has:
        info.append(("BAF", share("baf")))
        known = F.col("n_baf_probes") > 0 if "n_baf_probes" in has else F.col("baf").isNotNull()
        last = [("BAF", share("baf"))]
        if "n_baf_probes" in has:
            info.append(("BAF_PROBES", whole("n_baf_probes")))
            last.append(("BAFQ", whole("n_baf_probes")))
        form += [F.when(known, F.lit(k)) for k, _ in last]
        data += [F.when(known, v) for _, v in last]
    text = F.concat_ws(";", *[F.concat(F.lit(f"{k}="), v) for k, v in info])
    alt = F.concat(F.lit("<"), "svtype", F.lit(">"))
    return segments.select(F.concat_ws("\t", "contig", F.col("start").cast("string"), F.lit("."), F.lit("N"), alt, F.lit("."), F.lit("."), text, F.concat_ws(":", *form), F.concat_ws(":", *data)).alias("value"))


def vcf_info(line: Column) -> Column:
    """INFO of a VCF line as a map."""
    return F.str_to_map(F.split_part(line, F.lit("\t"), F.lit(8)), F.lit(";"), F.lit("="))


def keep_annotated(v: DataFrame, info: str = "info", least_depth: int = 50, least_af: float = 0.001) -> DataFrame:
    """Variants whose INFO map has a DP above ``least_depth`` and a MAX_AF of ``least_af`` or more; without either a variant goes."""
    number = lambda key: F.get(F.array(F.col(info)[key]), F.lit(0)).try_cast("double")
    return v.where((number("DP") > least_depth) & (number("MAX_AF") >= least_af))


def hard_filters(v: DataFrame, least_af: float = 0.05, most_nm: float = 7.0) -> DataFrame:
    """``filter``: tags of the hard filters that a small variant fails, joined by ;, PASS if none; with gt and qual_vcf.

    Rows with an amplicon flag are judged by their amplicons (gamp, tamp, ncamp) too.
    """
    amplicon = F.col("ampflag").isNotNull() if "ampflag" in v.columns else F.lit(False)
    flagged = F.col("ampflag").isin("", "0") == F.lit(False) if "ampflag" in v.columns else F.lit(False)
    amplicons = lambda c: F.col(c).cast("string").try_cast("long")
    missed = amplicons("gamp") < amplicons("tamp") - amplicons("ncamp") if "ampflag" in v.columns else F.lit(False)
    weak = F.col("hicnt") * F.col("hiaf") < 0.5
    length = F.abs(F.length("ref") - F.length("alt"))
    ratio = F.col("oddratio")
    odds = F.when(ratio == float("inf"), 0.0).when((ratio > 0) & (ratio < 1), 1 / ratio).otherwise(ratio)
    msi = (length == F.col("msilen")) & (((F.col("msi") > 12) & (F.col("msilen") > 1) & (F.col("af") < 0.2)) | ((F.col("msi") >= 13) & (F.col("msilen") == 1) & (F.col("af") <= 0.275)))
    long_msi = (length == F.col("msilen")) & (((F.col("hiaf") <= 0.275) & (F.col("msi") >= 13)) | ((F.col("hiaf") <= 0.2) & (F.col("msi") >= 8) & (F.col("msilen") > 1)))
    bias = (F.col("hiaf") < 0.25) & (F.col("bias") == "2;1") & (F.col("sbf") < 0.01) & ((odds > 5) | (odds == 0)) & (F.col("end") - F.col("start") < 100)
    rules = (
        ("d3", (F.col("dp") < 3) & weak),
        ("v2", (F.col("hicnt") < 2) & weak),
        (f"f{least_af:g}", F.col("af") < least_af),
        ("p8", F.col("pmean") < 8),
        ("pSTD", (F.col("pstd") == 0) & (F.col("af") < 0.35) & ~amplicon),
        ("q22.5", F.col("qual") < 22.5),
        ("Q10", (F.col("mapq") < 10) & (F.col("af") < 0.8)),
        ("SN1.5", F.col("sn") < 1.5),
        (f"NM{most_nm:g}", F.col("nm") > most_nm),
        ("MSI12", msi),
        ("Bias", bias),
        ("LongMSI", long_msi),
        ("AMPBIAS", amplicon & (F.coalesce(missed, F.lit(False)) | flagged)),
    )
    failed = F.array_compact(F.array(*[F.when(rule, tag) for tag, rule in rules]))
    gt = F.when(1 - F.col("af") < 0.2, "1/1").when(F.col("af") >= 0.5, "1/0").when(F.col("af") >= least_af, "0/1").otherwise("0/0")
    quality = F.when(F.col("vd") <= 1, 0).otherwise(F.floor(F.round(F.log2(F.col("vd").cast("double")) * F.col("qual"), 9))).cast("long")
    return v.withColumn("filter", F.when(F.size(failed) == 0, "PASS").otherwise(F.array_join(failed, ";"))).withColumn("gt", gt).withColumn("qual_vcf", quality)


def best_per_position(v: DataFrame, ties: tuple, every: bool = False, by: tuple = ()) -> DataFrame:
    """The variant of the highest allele frequency at each position, or ``every`` one, repeats of (chr, start, end, ref, alt) left out; of each sample if ``by`` names its column."""
    same = ("chr", "start", "end", "ref", "alt") if every else ("chr", "pos")
    order = Window.partitionBy(*by, *same).orderBy(F.col("af").desc(), *ties)
    return v.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def flag_clusters(v: DataFrame, within: int, ties: tuple = (), by: tuple = ()) -> DataFrame:
    """``filter``: Cluster{within}bp for a passing SNV that starts less than ``within`` after the SNV that passed last, and for the record before it.

    Each chromosome, and each sample if ``by`` names its column, is looked at alone. A clustered SNV
    does not count as passed, so the SNVs that pass are the starts of greedy groups; chromosomes lie in
    many ranges (``ranges.greedy_groups``).
    """
    keys, order = (*by, "chr"), ("pos", *ties)
    passing = F.coalesce((F.col("filter") == "PASS") & (F.col("type") == "SNV"), F.lit(False))
    place = F.when(passing, F.col("pos"))
    marked = materialize(ranges.greedy_groups(v.withColumn("__passes", passing), keys, order, place, place, within - 1).drop("__group"))
    clustered = F.col("__passes") & ~F.col("__starts")
    after = ranges.following(marked, keys, order, "__after", clustered)
    hit = clustered | F.coalesce("__after", F.lit(False))
    return after.withColumn("filter", F.when(hit, f"Cluster{within}bp").otherwise(F.col("filter"))).select(*v.columns)


#: INFO fields of small-variant VCFs and the columns that they come from; ids are fixed by the format's readers.
SMALL_INFO = (
    ("TYPE", "type"), ("DP", "dp"), ("END", "end"), ("VD", "vd"), ("AF", "af"), ("BIAS", "bias"), ("REFBIAS", "rfwd:rrev"), ("VARBIAS", "vfwd:vrev"), ("PMEAN", "pmean"), ("PSTD", "pstd"),
    ("QUAL", "qual"), ("QSTD", "qstd"), ("SBF", "sbf"), ("ODDRATIO", "oddratio"), ("MQ", "mapq"), ("SN", "sn"), ("HIAF", "hiaf"), ("ADJAF", "adjaf"), ("SHIFT3", "shift3"), ("MSI", "msi"),
    ("MSILEN", "msilen"), ("NM", "nm"), ("HICNT", "hicnt"), ("HICOV", "hicov"), ("LSEQ", "lseq"), ("RSEQ", "rseq"),
)
AMPLICON_INFO = (("GDAMP", "gamp"), ("TLAMP", "tamp"), ("NCAMP", "ncamp"), ("AMPFLAG", "ampflag"))
#: The same columns where there are no amplicons: duplication rate, and reads of genome editing.
PLAIN_INFO = (("DUPRATE", "gamp"), ("CRISPR", "ncamp"))
STRUCTURAL_INFO = ("SVTYPE", "SVLEN", "SPLITREAD", "SPANPAIR")


def small_variant_header(least_af: float = 0.05, most_nm: float = 7.0, within: int = 1) -> list[str]:
    """Header lines of a VCF 4.1 file of small variants."""
    fields = [(i, "1", "String", f"from {c}") for i, c in (("SAMPLE", "sample"), *SMALL_INFO, *AMPLICON_INFO, *PLAIN_INFO, *((i, "alt, tamp") for i in STRUCTURAL_INFO))]
    form = [("GT", "1", "String", "Genotype"), *[(i, n, "Integer", d) for i, n, d in (("DP", "1", "Depth"), ("VD", "1", "Variant depth"), ("AD", ".", "Depth of each allele"))]]
    form += [("AF", "1", "Float", "Allele frequency"), ("RD", "2", "Integer", "Reference reads by strand"), ("ALD", "2", "Integer", "Variant reads by strand")]
    tags = ("d3", "v2", f"f{least_af:g}", "p8", "pSTD", "q22.5", "Q10", "SN1.5", f"NM{most_nm:g}", "MSI12", "Bias", "LongMSI", f"Cluster{within}bp", "AMPBIAS")
    return vcf_header(tuple(fields), tuple(form), "4.1", tuple((t, f"fails {t}") for t in tags))


def small_variant_lines(v: DataFrame, least_split: int = 1) -> DataFrame:
    """(value) VCF 4.1 data lines of small variants with filter, gt and qual_vcf.

    Columns that the table lacks or that are null give no INFO field; blanks in a sample's name become underscores.
    Rows without an amplicon flag are not of amplicons: their tamp is "split reads-spanning pairs-cluster",
    and an alternative in angle brackets, a structural one, needs ``least_split`` split reads to be written.
    """
    has = set(v.columns)
    text = lambda c: F.col(c).cast("string")
    whole = ~F.col("ampflag").isNotNull() if "ampflag" in has else F.lit(True)
    tamp = text("tamp") if "tamp" in has else F.lit(None).cast("string")
    reads = lambda i: F.coalesce(F.when(tamp.contains("-"), F.get(F.split(tamp, "-"), F.lit(i)).try_cast("long")), F.lit(0).cast("long"))
    structural = whole & F.col("alt").contains("<")
    v = v.where(~F.coalesce(structural, F.lit(False)) | (reads(0) >= least_split))

    def value(source: str):
        parts = source.split(":")
        if not set(parts) <= has:
            return None
        if source == "bias":
            return F.regexp_replace(text("bias"), ";", ":")
        return F.concat_ws(":", *[text(c) for c in parts]) if len(parts) > 1 else text(source)

    info = [F.concat(F.lit("SAMPLE="), F.regexp_replace("sample", r"\s", "_"))] if "sample" in has else []
    for name, source in (*SMALL_INFO, *(AMPLICON_INFO if "ampflag" in has else ())):
        shown = value(source)
        if shown is not None:
            shown = F.when(F.col("ampflag").isNotNull(), shown) if (name, source) in AMPLICON_INFO else shown
            info.append(F.concat(F.lit(f"{name}="), shown))
    info += [F.when(whole, F.concat(F.lit(f"{name}="), text(source))) for name, source in PLAIN_INFO if source in has]
    length = F.col("end") - F.col("start") + F.when(F.col("alt").contains("INV"), 1).otherwise(0)
    info.append(F.when(structural, F.concat(F.lit("SVTYPE="), F.regexp_replace("alt", "[<>]", ""), F.lit(";SVLEN="), length.cast("string"))))
    info.append(F.when(whole & tamp.isNotNull(), F.concat(F.lit("SPLITREAD="), reads(0).cast("string"), F.lit(";SPANPAIR="), reads(1).cast("string"))))
    rd, ald = F.concat_ws(",", text("rfwd"), text("rrev")), F.concat_ws(",", text("vfwd"), text("vrev"))
    ad = F.concat_ws(",", (F.col("rfwd") + F.col("rrev")).cast("string"), text("vd"))
    sample = F.concat_ws(":", "gt", text("dp"), text("vd"), ad, text("af"), rd, ald)
    return v.select(F.concat_ws("\t", "chr", text("start"), F.lit("."), "ref", "alt", text("qual_vcf"), "filter", F.concat_ws(";", *info), F.lit("GT:DP:VD:AD:AF:RD:ALD"), sample).alias("value"))


def merge_overlapping(calls: DataFrame, width: int, share: float = 0.6) -> DataFrame:
    """(id, group): calls of a chromosome and type that overlap reciprocally, directly or over others; group is the smallest id.

    Calls of the same place and type are one node. Nodes are first linked to the one before them in the order of
    their starts among those of like length, which joins piles; only nodes that this leaves in different groups
    then meet in pairs.
    """
    from helixframe.operators.graph import connected_components

    same = ["chr", "svtype", "start", "end"]
    straight = calls.where((F.col("start") <= F.col("end")) & F.col("id").isNotNull())
    nodes = materialize(straight.groupBy(*same).agg(F.min("id").alias("node")))
    own = calls.join(nodes, same, "left").groupBy("id").agg(F.min("node").alias("node"), F.collect_set("node").alias("__nodes"))
    own = materialize(own.withColumn("node", F.when(F.col("id").isNotNull(), F.col("node"))))
    # An id of several places links them.
    links = own.where(F.size("__nodes") > 1).select("node", F.explode("__nodes").alias("b"))
    if share > 0:
        near = reciprocal_neighbours(nodes, share, ("chr", "svtype"))
        first = connected_components(near.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).unionByName(links.select(F.col("node").alias("a"), "b")))
        grouped = materialize(_renamed(nodes, "node", first, "group"))
        met = reciprocal_pairs(grouped, grouped, share, ("chr", "svtype"), "group").select(F.col("a_group").alias("a"), F.col("b_group").alias("b"))
    else:
        grouped = nodes.withColumn("group", F.col("node"))
        met = _same_type_pairs(nodes, nodes, width, share).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).unionByName(links.select(F.col("node").alias("a"), "b"))
    found = _renamed(grouped.select("node", "group"), "group", connected_components(met), "group").select("node", "group").distinct()  # an id may be the smallest of several places
    return own.select("id", "node").join(found, "node", "left").select("id", F.coalesce("group", "id").alias("group"))


def _renamed(rows: DataFrame, column: str, components: DataFrame, name: str) -> DataFrame:
    """``name``: the component of a column's node, or the node itself."""
    joined = rows.join(components.withColumnRenamed("node", "__node"), F.col(column) == F.col("__node"), "left")
    return joined.withColumn(name, F.coalesce("component", column)).drop("__node", "component")


def _same_type_pairs(a: DataFrame, b: DataFrame, width: int, share: float) -> DataFrame:
    """Pairs of a chromosome and type that overlap reciprocally; of no share, all that overlap."""
    if share > 0:
        return reciprocal_pairs(a, b, share, ("chr", "svtype"))
    return overlaps(a, b, width).where((F.col("a_svtype") == F.col("b_svtype")) & reciprocal_overlap(share))


def population_frequency(calls: DataFrame, database: DataFrame, width: int, share: float = 0.6) -> DataFrame:
    """Calls with the count and frequency of the database entry that they overlap best, null if none overlaps enough.

    Calls of the same place and type are looked up once; of such entries the one of the smallest id counts.
    """
    same = ["chr", "svtype", "start", "end"]
    entries = database.groupBy(*same).agg(F.min("id").alias("id"), F.min_by(F.struct("ac", "af"), "id").alias("hit"))
    met = _same_type_pairs(calls.select(*same).distinct(), entries, width, share)
    best = met.groupBy(*[F.col(f"a_{c}").alias(c) for c in same]).agg(F.max_by("b_hit", F.struct(shared_length(), F.negative("b_id"))).alias("hit"))
    return calls.join(best, same, "left").select(*calls.columns, F.col("hit.ac").alias("ac"), F.col("hit.af").alias("freq"))


def called_segments(calls: DataFrame, least_freq: float = 0.0, kinds: tuple = ()) -> DataFrame:
    """Calls that another caller's table takes part with: passing, of the ``kinds`` if any are named, not rarer than ``least_freq``."""
    kept = calls.where(F.col("filter").isin("PASS", "."))
    kept = kept.where(F.col("svtype").isin(*kinds)) if kinds else kept
    return kept.where(F.coalesce(F.col("freq"), F.lit(1.0)) >= least_freq) if "freq" in calls.columns else kept


def unified_calls(calls: DataFrame, most_copies: int = 10, least_probes: int = 25) -> DataFrame:
    """Calls of any callers that a unified table takes: changed copy numbers from 0 on, those of ``most_copies`` or more only on more than ``least_probes`` probes.

    A call whose normal state costs no more than its own (norm_weight <= weight) is normal. Columns that
    a caller does not give are null and decide nothing.
    """
    cn = F.col("cn").try_cast("double")
    normal = F.coalesce(F.col("norm_weight") <= F.col("weight"), F.lit(False))
    many = F.coalesce((cn < most_copies) | F.col("probes").isNull() | (F.col("probes") > least_probes), F.lit(True))
    return calls.where(~normal & (cn.isNull() | ((cn >= 0) & (cn != 2) & many)))


def unified_segments(calls: DataFrame, by: tuple = ("chr", "svtype"), callers: tuple = ()) -> DataFrame:
    """(``by``, start, end, callers, n_callers): disjoint pieces of the calls (``by``, start, end, caller) of several callers, each with all callers whose calls hold it.

    A sweep over breakpoints: each caller's own calls are fused where they touch or overlap, so that
    every breakpoint changes the set of callers; sums of openings and closings along the breakpoints
    give the set, and the next breakpoint ends the piece. Keys lie in many ranges. ``callers`` are the
    names to look for, by default those that occur (one row each). Calls that end before they start, or
    lack an end or start, hold nothing.
    """
    rows = calls.where(F.col("end") >= F.col("start")).select(*by, "caller", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    keys = (*by, "caller")
    own = ranges.running(ranges.deal(rows, *keys, "start", "end"), keys, ("start", "end"), "__before", F.col("end"), F.max, itself=False)
    own = own.withColumn("__fresh", F.coalesce(F.col("start") > F.col("__before") + 1, F.lit(True)).cast("long")).drop("__before")
    fused = ranges.running(materialize(own), keys, ("start", "end"), "__island", F.col("__fresh")).groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    names = callers or tuple(r["caller"] for r in rows.select("caller").where("caller is not null").distinct().orderBy("caller").collect()) or ("",)
    edges = materialize(fused.select(*keys, F.inline(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("end") + 1).alias("pos"), F.lit(-1).alias("d"))))))
    net = [F.sum(F.when(F.col("caller") == n, F.col("d")).otherwise(0)).alias(f"__d{i}") for i, n in enumerate(names)]
    changed = ranges.following(ranges.deal(edges.groupBy(*by, "pos").agg(*net), *by, "pos"), by, ("pos",), "__next", F.col("pos"))
    for i in range(len(names)):
        changed = ranges.running(changed, by, ("pos",), f"__n{i}", F.col(f"__d{i}"))
    held = F.array_compact(F.array(*[F.when(F.col(f"__n{i}") > 0, n) for i, n in enumerate(names)]))
    pieces = changed.withColumn("__held", held).where(F.size("__held") > 0)
    return pieces.select(*by, F.col("pos").alias("start"), (F.col("__next") - 1).alias("end"), F.array_join(F.array_sort("__held"), ",").alias("callers"), F.size("__held").alias("n_callers"))


def _region_counts(at: DataFrame, regions: DataFrame) -> DataFrame:
    """``at`` with n, how many of the regions (chr, start, end, n) each row overlaps: those that start until its end less those that end before its start."""
    zero = F.lit(0).cast("long")
    bounds = regions.select("chr", F.inline(F.array(F.struct(F.col("start").alias("pos"), F.col("n").alias("starts"), zero.alias("ends")), F.struct(F.col("end").alias("pos"), zero.alias("starts"), F.col("n").alias("ends")))))
    asked = at.select("chr", F.explode(F.array("start", "end")).alias("pos"), zero.alias("starts"), zero.alias("ends"))
    summed = bounds.unionByName(asked).groupBy("chr", "pos").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    dealt = ranges.running(ranges.deal(summed, "chr", "pos"), ("chr",), ("pos",), "__started", F.col("starts"))
    along = materialize(ranges.running(dealt, ("chr",), ("pos",), "__ended", F.col("ends"), itself=False).select("chr", "pos", "__started", F.coalesce("__ended", zero).alias("__ended")))
    until = at.join(along.select("chr", F.col("pos").alias("end"), "__started"), ["chr", "end"])
    return until.join(along.select("chr", F.col("pos").alias("start"), "__ended"), ["chr", "start"]).withColumn("n", F.col("__started") - F.col("__ended")).select(*at.columns, "n")


def _fused_by_name(regions: DataFrame) -> DataFrame:
    """(chr, region_name, start, end): regions (start <= end) of a chromosome and name, each once, as one where they overlap."""
    keys, order = ("chr", "region_name"), ("start", "end")
    own = ranges.running(ranges.deal(regions.select(*keys, *order), *keys, *order), keys, order, "__before", F.col("end"), F.max, itself=False)
    own = own.withColumn("__fresh", F.coalesce(F.col("start") > F.col("__before"), F.lit(True)).cast("long")).drop("__before")
    return ranges.running(materialize(own), keys, order, "__island", F.col("__fresh")).groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


def callers_by_region(segments: DataFrame, panel: DataFrame, width: int) -> DataFrame:
    """Segments with the names of the panel regions that they overlap, sorted and comma-joined, and their number.

    Pairs are not made: segments of the same places are looked at once, the number of regions comes from
    sums along the positions, and the names from the fused regions of each name. Only intervals that end
    before they start meet in pairs.
    """
    known = lambda df: df.where("chr is not null and start is not null and end is not null")
    straight = F.col("start") <= F.col("end")
    placed = known(segments).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("chr", "start", "end"))).alias("__places"))
    looked = materialize(placed.select("__places").distinct().withColumn("__set", F.monotonically_increasing_id()))
    at = looked.select("__set", F.inline("__places"))
    each = materialize(known(panel).groupBy("chr", "start", "end", "region_name").agg(F.count("*").alias("n")))
    flat = at.where(straight)
    counts = _region_counts(flat, each.where(straight).groupBy("chr", "start", "end").agg(F.sum("n").alias("n"))).select("__set", "n")
    named = overlaps(flat, _fused_by_name(each.where(straight & F.col("region_name").isNotNull())), width).select(F.col("a___set").alias("__set"), F.col("b_region_name").alias("region_name"))
    for left, right in ((at.where(~straight), each), (flat, each.where(~straight))):
        if not left.isEmpty() and not right.isEmpty():
            odd = overlaps(left, right, width)
            counts = counts.unionByName(odd.select(F.col("a___set").alias("__set"), F.col("b_n").alias("n")))
            named = named.unionByName(odd.select(F.col("a___set").alias("__set"), F.col("b_region_name").alias("region_name")))
    names = named.groupBy("__set").agg(F.array_join(F.array_sort(F.collect_set("region_name")), ",").alias("region_names"))
    total = counts.groupBy("__set").agg(F.sum("n").alias("n_regions")).where("n_regions > 0")
    found = looked.join(total, "__set").join(names, "__set", "left").select("__places", F.coalesce("region_names", F.lit("")).alias("region_names"), "n_regions")
    return placed.join(found, "__places").select("id", "region_names", "n_regions")


#: Expected allele frequencies of the genotype classes.
FREQUENCIES = (0.0, 0.25, 0.33, 0.5, 0.66, 0.75, 1.0)


def genotype_classes(v: DataFrame, trisomy: float = 0.01, tetrasomy: float = 0.005) -> DataFrame:
    """(…, vaf, hom_prob, het_prob, tri_prob, quad_prob): classes of allele frequencies given alt and ref counts.

    The priors follow from ``pop_het``, the share of heterozygotes: homozygotes of either allele share
    what is left, trisomies and tetrasomies take their parts of pop_het. Tetrasomies with two alleles
    each look like heterozygotes, so het_prob is less, and quad_prob all of, the tetrasomies' prior.
    """
    het = F.col("pop_het")
    quad, tri, hom = het * tetrasomy / 3, het * trisomy / 2, (1 - het) / 2
    priors = (hom, quad, tri, het - 2 * quad - 2 * tri, tri, quad, hom)

    def score(p: float) -> Column:
        # 0 times the logarithm of 0 is 0 here.
        part = lambda n, q: F.lit(0.0) if q == 1 else F.when(n == 0, 0.0).otherwise(n * F.ln(F.lit(q)) if q > 0 else F.lit(-1e9))
        return part(F.col("alt_count"), p) + part(F.col("ref_count"), 1 - p)

    scores = F.array(*[score(p) for p in FREQUENCIES])
    weighed = let(scores, lambda s: let(F.array_max(s), lambda top: F.zip_with(s, F.array(*priors), lambda x, w: w * F.exp(x - top))))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    shares = let(weighed, lambda a: let(total(a), lambda t: F.transform(a, lambda x: F.try_divide(x, t))))
    found = v.withColumn("__p", shares)
    p = lambda i: F.get("__p", F.lit(i))
    return found.withColumns({"vaf": vaf(), "hom_prob": p(0) + p(6), "het_prob": p(3) - 2 * quad, "tri_prob": p(2) + p(4), "quad_prob": 4 * quad}).drop("__p")


def vaf() -> Column:
    """Share of the alternative allele in a site's depth, null without depth."""
    return F.try_divide(F.col("alt_count").cast("double"), (F.col("alt_count") + F.col("ref_count")).cast("double"))
