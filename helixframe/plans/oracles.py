"""DuckDB SQL with the rows of the registered queries."""

from __future__ import annotations

from helixframe.functions.genome import ERF
from helixframe.functions.model import DISTANCE, DISTANCE_SCALE, GENOTYPES, PRIOR_WEIGHTS, STATES, false_positive, prior, transitions
from helixframe.plans.views import with_views as V

_SIZES = V("g_reads") + ", sizes AS (SELECT chr, max(pos) + 1 AS chr_size FROM g_reads GROUP BY chr)"


def _bins(overlap: int = 0) -> str:
    return (
        _SIZES
        + f""", binned AS (
  SELECT chr, i * 50000 - CASE WHEN i > 0 THEN {overlap} ELSE 0 END AS start, CAST(CASE WHEN chr_size <= 50000 THEN chr_size - 1 WHEN i = chr_size // 50000 THEN chr_size ELSE i * 50000 + 49999 END AS BIGINT) AS "end", i AS ordinal
  FROM sizes, LATERAL (SELECT unnest(range(0, CASE WHEN chr_size > 50000 THEN chr_size // 50000 ELSE 0 END + 1)) AS i))"""
    )


_BINS = _bins()
_GC = (
    V("g_cov")
    + """, cov AS (
  SELECT sample, chr, start, "end", cov_raw / avg(cov_raw) OVER (PARTITION BY sample) * (SELECT avg(cov_raw) FROM g_cov) AS cov, (start // 86400) * 7 % 30 / 60.0::DOUBLE + 0.2::DOUBLE AS gc FROM g_cov),
fit AS (SELECT sample, regr_slope(cov, gc) AS slope, regr_intercept(cov, gc) AS intercept FROM cov GROUP BY sample),
normed AS (SELECT cov.*, slope, intercept, cov / (slope * gc + intercept) * (SELECT avg(cov) FROM cov) AS cov_norm FROM cov JOIN fit USING (sample))"""
)
_ALLELES = (
    V("g_pile", "g_snps")
    + """, wide AS (
  SELECT sample, site, CAST(coalesce(sum(n) FILTER (base = 'A'), 0) AS BIGINT) AS n_a, CAST(coalesce(sum(n) FILTER (base = 'C'), 0) AS BIGINT) AS n_c,
         CAST(coalesce(sum(n) FILTER (base = 'G'), 0) AS BIGINT) AS n_g, CAST(coalesce(sum(n) FILTER (base = 'T'), 0) AS BIGINT) AS n_t FROM g_pile GROUP BY ALL),
alleles AS (
  SELECT w.*, s.chr, s.pos, s.baf, n_a + n_c + n_g + n_t AS cov, CASE alt WHEN 'A' THEN n_a WHEN 'C' THEN n_c WHEN 'G' THEN n_g ELSE n_t END AS alt_count FROM wide w JOIN g_snps s USING (site)),
counted AS (SELECT *, cov - alt_count AS ref_count FROM alleles)"""
)
_FLOOR = f"{false_positive()!r}::DOUBLE"
_COPIES = "(VALUES (0, 0.0::DOUBLE), (1, 0.5), (2, 1.0), (3, 1.5), (4, 2.0), (5, 2.5), (6, 1.0)) st(state, half)"


def _costs(likelihoods: str, keys: str) -> str:
    """From a table with keys, state, bonus and p: normalise, add bonus and floor, normalise, -log."""
    return f"""one AS (SELECT {keys}, state, coalesce(p / nullif(sum(p) OVER (PARTITION BY {keys}), 0), 0) + bonus + {_FLOOR} AS p FROM {likelihoods}),
two AS (SELECT {keys}, state, p / sum(p) OVER (PARTITION BY {keys}) AS p FROM one),
costs AS (SELECT {keys}, state, CASE WHEN p > 0 THEN -ln(p) ELSE 1000.0 END AS nll FROM two)"""


_NB = (
    V("g_cov")
    + f""", m AS (SELECT sample, chr, start, cov_raw::DOUBLE AS k, avg(cov_raw) OVER (PARTITION BY sample) AS m, var_samp(cov_raw) OVER (PARTITION BY sample) AS v FROM g_cov),
mv AS (SELECT sample, chr, start, k, state, CASE WHEN state = 5 AND k > m * 2.5 THEN 1e-10 ELSE 0 END AS bonus, CASE WHEN half > 0 THEN m * half ELSE 1.0 END AS mu, CASE WHEN half > 0 THEN v * half ELSE 50.0 END AS var FROM m, {_COPIES}),
ms AS (SELECT *, mu * mu / greatest(var - mu, 1e-6 * mu) AS r FROM mv),
nb AS (SELECT sample, chr, start, state, bonus, exp(lgamma(k + r) - lgamma(r) - lgamma(k + 1) + r * ln(r / (r + mu)) + k * ln(mu / (r + mu))) AS p FROM ms),
{_costs("nb", "sample, chr, start")}"""
)
_P, _A1, _A2, _A3, _A4, _A5 = ERF
_ERF_T = f"(1 / (1 + {_P} * y))"
_SNP_STATES = ", ".join(f"({STATES.index(s)}, {variant / copies!r}::DOUBLE, {w!r}::DOUBLE)" for s, copies, variant, w in GENOTYPES if copies)


def _beta(a: str, b: str) -> str:
    """P(Beta(a + 1, b + 1) <= 0.1)."""
    return f"""list_sum(list_transform(range({a} + 1, {a} + {b} + 2), lambda i: exp(lgamma({a} + {b} + 2) - lgamma(i + 1) - lgamma({a} + {b} + 2 - i) + i * ln(0.1) + ({a} + {b} + 1 - i) * ln(0.9))))"""


def _snp(extra: str = "") -> str:
    keys = "sample, site"
    return (
        _ALLELES
        + f""", best AS (
  SELECT sample, site, state, exp(score - max(score) OVER (PARTITION BY sample, site)) AS p FROM (
    SELECT sample, site, g.state, max(ln(g.w) + CASE WHEN alt_count = 0 THEN 0 WHEN g.e > 0 THEN alt_count * ln(g.e) ELSE -1e9 END + CASE WHEN ref_count = 0 THEN 0 WHEN g.e < 1 THEN ref_count * ln(1 - g.e) ELSE -1e9 END) AS score
    FROM counted, (VALUES {_SNP_STATES}) g(state, e, w) GROUP BY ALL)),
first AS (SELECT {keys}, state, coalesce(p / nullif(sum(p) OVER (PARTITION BY {keys}), 0), 0) + {_FLOOR} AS p FROM best),
second AS (SELECT {keys}, state, p / sum(p) OVER (PARTITION BY {keys}) AS p FROM first),
hom AS (SELECT sample, site, chr, pos, 2 * baf * (1 - baf) AS het, greatest({_beta("alt_count", "ref_count")}, {_beta("ref_count", "alt_count")}) AS h FROM counted),
mixed AS (SELECT {keys}, state, het * p + (1 - het) * h AS p FROM second JOIN hom USING (sample, site)),
last AS (SELECT {keys}, state, p / sum(p) OVER (PARTITION BY {keys}) * (1 - 1 / 7.0::DOUBLE) AS p FROM mixed UNION ALL SELECT {keys}, 0, 1 / 7.0::DOUBLE FROM counted),
snp_costs AS (SELECT {keys}, state, CASE WHEN p > 0 THEN -ln(p) ELSE 1000.0 END AS nll FROM last)"""
        + extra
    )


_RUNS = (
    V("g_calls")
    + """, changed AS (
  SELECT *, CASE WHEN cn_pred = lag(cn_pred) OVER (PARTITION BY sample, chr ORDER BY start) THEN 0 ELSE 1 END AS fresh,
         (cov - avg(cov) OVER (PARTITION BY sample)) / stddev_samp(cov) OVER (PARTITION BY sample) AS sd_distance FROM g_calls),
runs AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY sample, chr ORDER BY start) AS BIGINT) AS cn_id FROM changed),
rolled AS (
  SELECT sample, chr, cn_id, arg_min(cn_pred, start) AS cn_pred, min(start) AS start, max("end") AS "end", max("end") - min(start) AS length,
         median(cov) AS median_cov, median(sd_distance) AS median_sd_distance, count(*) AS n_regions FROM runs GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY length DESC, chr, start) AS place FROM rolled WHERE cn_pred <> '2')"""
)


def _svs(name: str, shift: int = 0) -> str:
    return f"""{name} AS (SELECT p_partkey AS id, p_brand AS chr, p_partkey % 200 * 50 + {shift} AS start, p_partkey % 200 * 50 + {shift} + p_size * 100 AS "end",
      CASE WHEN p_size % 2 = 0 THEN 'DEL' ELSE 'DUP' END AS svtype, p_size, p_name FROM part)"""


_RECIPROCAL = """a.chr = b.chr AND a.svtype = b.svtype AND a.start <= b."end" AND b.start <= a."end"
  AND least(a."end", b."end") - greatest(a.start, b.start) + 1 >= 0.6::DOUBLE * (a."end" - a.start + 1) AND least(a."end", b."end") - greatest(a.start, b.start) + 1 >= 0.6::DOUBLE * (b."end" - b.start + 1)"""


def _segment_cn(ccn: str) -> str:
    return (
        V("g_seg")
        + f""", cns AS (SELECT *, round_even(raw, 2) AS cn, {ccn} AS ccn FROM (SELECT *, 2 * pow(2.0::DOUBLE, log2) AS raw FROM g_seg)),
typed AS (SELECT contig, start, "end", log2, cn, ccn, CASE WHEN cn < 1.5 THEN 'DEL' WHEN cn > 2.5 THEN 'DUP' ELSE 'COPY_NORMAL' END AS svtype FROM cns),
seg AS (SELECT *, CASE WHEN cn < 0.5 THEN '1/1' WHEN svtype = 'COPY_NORMAL' THEN '0/0' ELSE '0/1' END AS gt FROM typed),
probed AS (SELECT *, start // 1000 % 50 AS probes, start // 1000 % 3 AS sites, (start // 1000 % 50) / 100.0::DOUBLE AS baf FROM seg)"""
    )


_PURE = _segment_cn("round_even(2 + (raw - 2) * (1 / 0.5::DOUBLE), 2)")
_SMALL = """WITH v AS (
  SELECT *, l_returnflag AS chr, l_orderkey AS pos, l_linenumber * 30 AS span, substr('AAAA', 1, (1 + l_partkey % 3)::INT) AS ref, 'A' AS alt, l_quantity AS dp, l_linenumber AS vd, l_discount AS af, l_tax * 4 AS hiaf, l_linenumber AS hicnt,
         l_suppkey % 20 AS pmean, l_partkey % 2 AS pstd, l_quantity AS qual, l_partkey % 60 AS mapq, l_linenumber * 0.7::DOUBLE AS sn, l_suppkey % 10 AS nm, l_partkey % 15 AS msi, l_linenumber % 3 AS msilen,
         CASE WHEN l_linenumber % 2 = 0 THEN '2;1' ELSE '2;2' END AS bias, l_tax / 10 AS sbf, l_quantity / 10 AS odds0,
         CASE WHEN l_partkey % 4 = 0 THEN (l_suppkey % 2)::VARCHAR END AS ampflag, l_suppkey % 5 AS gamp, l_suppkey % 6 AS tamp, l_partkey % 2 AS ncamp, CASE WHEN l_linenumber < 5 THEN 'SNV' ELSE 'Insertion' END AS type,
         l_partkey % 9 AS rfwd, l_suppkey % 9 AS rrev, l_linenumber % 3 AS vfwd, l_linenumber % 2 AS vrev FROM lineitem),
w AS (SELECT *, CASE WHEN odds0 > 0 AND odds0 < 1 THEN 1 / odds0 ELSE odds0 END AS odds, abs(length(ref) - length(alt)) AS dl FROM v)"""
_FILTERED = (
    _SMALL
    + """, f AS (SELECT *, list_filter([
        CASE WHEN dp < 3 AND hicnt * hiaf < 0.5 THEN 'd3' END, CASE WHEN hicnt < 2 AND hicnt * hiaf < 0.5 THEN 'v2' END, CASE WHEN af < 0.05 THEN 'f0.05' END, CASE WHEN pmean < 8 THEN 'p8' END, CASE WHEN pstd = 0 AND af < 0.35 AND ampflag IS NULL THEN 'pSTD' END,
        CASE WHEN qual < 22.5 THEN 'q22.5' END, CASE WHEN mapq < 10 AND af < 0.8 THEN 'Q10' END, CASE WHEN sn < 1.5 THEN 'SN1.5' END, CASE WHEN nm > 7 THEN 'NM7' END,
        CASE WHEN dl = msilen AND ((msi > 12 AND msilen > 1 AND af < 0.2) OR (msi >= 13 AND msilen = 1 AND af <= 0.275)) THEN 'MSI12' END,
        CASE WHEN hiaf < 0.25 AND bias = '2;1' AND sbf < 0.01 AND (odds > 5 OR odds = 0) AND span < 100 THEN 'Bias' END,
        CASE WHEN dl = msilen AND ((hiaf <= 0.275 AND msi >= 13) OR (hiaf <= 0.2 AND msi >= 8 AND msilen > 1)) THEN 'LongMSI' END,
        CASE WHEN ampflag IS NOT NULL AND (gamp < tamp - ncamp OR ampflag <> '0') THEN 'AMPBIAS' END], lambda x: x IS NOT NULL) AS t FROM w),
  called AS (SELECT *, CASE WHEN len(t) = 0 THEN 'PASS' ELSE array_to_string(t, ';') END AS filter,
        CASE WHEN 1 - af < 0.2 THEN '1/1' WHEN af >= 0.5 THEN '1/0' WHEN af >= 0.05 THEN '0/1' ELSE '0/0' END AS gt, CASE WHEN vd <= 1 THEN 0 ELSE floor(round(log2(vd) * qual, 9)) END::BIGINT AS qual_vcf FROM f)"""
)
_SPEC = "(VALUES ('s0', 's1'), ('s2', 's3')) p(target, compared)"
_W = ", ".join(f"({i}, '{s}', {w}::DOUBLE)" for i, (s, w) in enumerate(zip(STATES, PRIOR_WEIGHTS)))

SQL = {
    "genome_binning": _BINS + ' SELECT chr, start, "end", ordinal FROM binned',
    "small_bin_filter": _BINS + ' SELECT chr, start, "end", ordinal FROM binned WHERE "end" - start > (SELECT max("end" - start) FROM binned) / 2.0::DOUBLE',
    "depth_per_bin": V("g_cov") + " SELECT * FROM g_cov",
    "library_size_norm": V("g_cov") + ' SELECT sample, chr, start, "end", cov_raw, round(cov_raw / avg(cov_raw) OVER (PARTITION BY sample) * (SELECT avg(cov_raw) FROM g_cov), 6) AS cov FROM g_cov',
    "coverage_clip": V("g_cov") + " SELECT sample, chr, start, round(least(cov_raw::DOUBLE, 3 * avg(cov_raw) OVER (PARTITION BY sample)), 6) AS clipped FROM g_cov",
    "overlap_trim": V("g_panel") + """ SELECT * FROM (SELECT chr, greatest(start, coalesce(lag("end") OVER (PARTITION BY chr ORDER BY start, "end") + 1, start)) AS start, "end", region_name FROM g_panel) WHERE "end" - start > 20""",
    "interbin_distance": V("g_panel") + """ SELECT chr, start, dist, round(coalesce(1 - 1 / (1 + exp(-(dist - 50000.0::DOUBLE) / 10000.0::DOUBLE)), 0), 6) AS t FROM (SELECT chr, start, start - lag("end") OVER (PARTITION BY chr ORDER BY start, "end") AS dist FROM g_panel)""",
    "gap_finder": V("g_panel") + """ SELECT *, gap_end - gap_start AS gap FROM (SELECT chr, "end" AS gap_start, lead(start) OVER (PARTITION BY chr ORDER BY start, "end") AS gap_end FROM (SELECT DISTINCT chr, start, "end" FROM g_panel)) WHERE gap_end - gap_start > 60000""",
    "panel_name_dedup": V("g_panel") + """ SELECT chr, start, "end", CASE WHEN count(*) OVER (PARTITION BY region_name) > 1 THEN region_name || '_' || row_number() OVER (PARTITION BY region_name ORDER BY ordinal) ELSE region_name END AS region_name, row_number() OVER (ORDER BY ordinal) AS region_id FROM g_panel""",
    "centromere_antijoin": V("g_cov") + """, c AS (SELECT chr, min(start) - 0.1::DOUBLE * (max("end") - min(start)) AS a, max("end") + 0.1::DOUBLE * (max("end") - min(start)) AS b FROM g_bins WHERE start // 86400 IN (12, 13) GROUP BY chr)
      SELECT sample, chr, start, "end", cov_raw FROM g_cov WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.chr = g_cov.chr AND g_cov.start <= b AND g_cov."end" >= a)""",
    "gc_content": """SELECT doc_id, round(CASE WHEN usable = 0 THEN -1 ELSE gc END, 6) AS gc, usable FROM (
      SELECT doc_id, len(regexp_replace(lower(text), '[^gc]', '', 'g')) / nullif(len(text), 0)::DOUBLE AS gc, coalesce(round(len(regexp_replace(lower(text), '[^gcat]', '', 'g')) / nullif(len(text), 0)::DOUBLE, 5), 0) AS usable FROM documents)""",
    "gc_regression_norm": _GC + " SELECT sample, chr, start, round(gc, 5) AS gc, round(slope, 5) AS slope, round(intercept, 5) AS intercept, round(cov_norm, 5) AS cov_norm FROM normed",
    "gc_bin_outliers": _GC + """, s AS (SELECT *, avg(cov_norm) OVER (PARTITION BY sample) AS m, stddev_samp(cov_norm) OVER (PARTITION BY sample) AS sd, CASE WHEN gc > 0 AND gc <= 1 THEN ceil(round(gc / 0.005, 9)) END AS gc_bin FROM normed),
      t AS (SELECT *, count(*) FILTER (cov_norm > m + 2.0 * sd) OVER (PARTITION BY sample, gc_bin) AS n_high FROM s),
      u AS (SELECT chr, start, "end", count(*) FILTER (n_high < 3 OR cov_norm < m + 2.0 * sd) AS n_ok FROM t GROUP BY ALL)
      SELECT * FROM u WHERE n_ok > 0.8::DOUBLE * (SELECT count(DISTINCT sample) FROM cov)""",
    "snp_point_in_region": V("g_panel") + """, r AS (SELECT *, row_number() OVER (ORDER BY ordinal) AS region_id FROM g_panel),
      p AS (SELECT p_partkey AS site, p_brand AS chr, p_partkey * 1000 + p_size * 131 % 3000 AS pos, 2 * (p_size / 51.0::DOUBLE) * (1 - p_size / 51.0::DOUBLE) AS het FROM part),
      o AS (SELECT site, p.chr, pos, region_id, row_number() OVER (PARTITION BY p.chr, pos ORDER BY region_id, het DESC, site) AS n FROM p JOIN r ON p.chr = r.chr AND pos BETWEEN r.start AND r."end")
      SELECT site, chr, pos, region_id FROM o WHERE n = 1""",
    "allele_pivot": _ALLELES + " SELECT sample, site, n_a, n_c, n_g, n_t, alt_count, ref_count FROM counted",
    "het_prior_and_depth_filter": _ALLELES + " SELECT sample, site, cov, round(2 * baf * (1 - baf), 6) AS pop_het FROM counted QUALIFY max(cov) OVER (PARTITION BY site) > 20",
    "sample_correlation": V("g_cov") + """, r AS (SELECT x.sample AS a, y.sample AS b, corr(x.cov_raw, y.cov_raw) AS r FROM g_cov x JOIN g_cov y USING (chr, start) GROUP BY ALL)
      SELECT a, b, round(r, 6) AS r, round(CASE WHEN a = b THEN 1.0 ELSE greatest(0, coalesce(r, 0)) END, 6) AS weight FROM r""",
    "weighted_mean_sd": V("g_cov") + """, r AS (SELECT x.sample AS a, y.sample AS b, corr(x.cov_raw, y.cov_raw) AS r FROM g_cov x JOIN g_cov y USING (chr, start) GROUP BY ALL),
      w AS (SELECT a, b, CASE WHEN a = b THEN 1.0 ELSE greatest(0, coalesce(r, 0)) END AS w FROM r),
      m AS (SELECT a, chr, start, cov_raw, w, sum(cov_raw * w) OVER (PARTITION BY a, chr, start) / sum(w) OVER (PARTITION BY a, chr, start) AS wm FROM w JOIN g_cov ON g_cov.sample = b WHERE w > 0),
      s AS (SELECT a, chr, start, min(wm) AS wm, sqrt(sum(w * (cov_raw - wm) * (cov_raw - wm)) / nullif((count(*) - 1) / count(*)::DOUBLE * sum(w), 0)) AS sd FROM m GROUP BY ALL)
      SELECT a AS sample, chr, start, round(wm, 5) AS w_mean, round(CASE WHEN sd IS NULL OR isnan(sd) THEN 1.0 ELSE sd END, 5) AS w_sd FROM s""",
    "nb_likelihood": _NB + " SELECT sample, chr, start, state::INT AS state, round(nll, 6) AS nll FROM costs",
    "normal_tail_likelihood": V("g_cov") + f""", m AS (SELECT sample, chr, start, cov_raw::DOUBLE AS k, avg(cov_raw) OVER (PARTITION BY sample) AS m, stddev_samp(cov_raw) OVER (PARTITION BY sample) AS sd FROM g_cov),
      z AS (SELECT sample, chr, start, state, abs((k - m * (0.75::DOUBLE * half + 0.25::DOUBLE)) / sd) / sqrt(2.0::DOUBLE) AS y FROM m, {_COPIES}),
      nb AS (SELECT sample, chr, start, state, 0 AS bonus, {_ERF_T} * ({_A1} + {_ERF_T} * ({_A2} + {_ERF_T} * ({_A3} + {_ERF_T} * ({_A4} + {_ERF_T} * {_A5})))) * exp(-y * y) AS p FROM z),
      {_costs("nb", "sample, chr, start")} SELECT sample, chr, start, state::INT AS state, round(nll, 6) AS nll FROM costs""",
    "snp_state_posterior": _snp() + " SELECT sample, site, state::INT AS state, round(nll, 6) AS nll FROM snp_costs",
    "probability_profile": _NB + ", profile AS (SELECT chr, start, state, avg(exp(-nll)) AS p FROM costs GROUP BY ALL) SELECT chr, start, state::INT AS state, round(p / sum(p) OVER (PARTITION BY chr, start), 6) AS share FROM profile",
    "run_length_segments": _RUNS + " SELECT sample, chr, start, cn_pred, cn_id FROM runs",
    "distance_break_groups": V("g_calls") + """, k AS (SELECT * FROM g_calls WHERE start // 86400 % 7 NOT IN (3, 4, 5)),
      f AS (SELECT *, CASE WHEN lead(start) OVER w - "end" > 200000 THEN 1 ELSE 0 END AS brk, CASE WHEN cn_pred = lag(cn_pred) OVER w THEN 0 ELSE 1 END AS fresh FROM k WINDOW w AS (PARTITION BY sample, chr ORDER BY start)),
      g AS (SELECT *, CAST(1 + coalesce(sum(brk) OVER (PARTITION BY sample, chr ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS join_region_id, CAST(sum(fresh) OVER (PARTITION BY sample, chr ORDER BY start) AS BIGINT) AS cn_id FROM f)
      SELECT sample, chr, start, join_region_id, cn_id, cn_id || '_' || join_region_id AS segment_id FROM g""",
    "segment_rollup_median": _RUNS + ' SELECT sample, chr, cn_id, cn_pred, start, "end", length, round(median_cov, 6) AS median_cov, round(median_sd_distance, 6) AS median_sd_distance, n_regions FROM rolled',
    "top3_longest_segments": _RUNS + ' SELECT sample, place, chr, start, "end", cn_pred, length FROM top WHERE place <= 3',
    "purity_from_segments": _RUNS + """, level AS (SELECT sample, CASE WHEN cn_pred <> '0' THEN cov / (cn_pred::DOUBLE / 2) WHEN cov > 0 THEN 'infinity'::DOUBLE END AS x FROM g_calls),
      normal AS (SELECT sample, median(x) AS norm_cov FROM level GROUP BY sample),
      genome AS (SELECT sample, sum(e) AS genome_size FROM (SELECT sample, chr, max("end") AS e FROM g_calls GROUP BY ALL) GROUP BY sample),
      implied AS (SELECT sample, length, (median_cov / nullif(norm_cov, 0) - 1) / nullif(cn_pred::DOUBLE / 2 - 1, 0) AS x FROM top JOIN normal USING (sample) WHERE place <= 3),
      mean AS (SELECT sample, sum(x * length) / sum(length) AS m, sum(length) AS total FROM implied WHERE x IS NOT NULL GROUP BY sample)
      SELECT sample, round(least(0.99, m), 6) AS purity, round(sqrt(sum(length * (x - m) * (x - m)) / sum(length)), 6) AS purity_sd, round(total / 1e6, 6) AS total_mbp, round(100 * total / genome_size::DOUBLE, 2) AS genome_percent
      FROM implied JOIN mean USING (sample) JOIN genome USING (sample) WHERE x IS NOT NULL GROUP BY sample, m, total, genome_size""",
    "named_segments_with_snps": _RUNS + ", " + _ALLELES.removeprefix("WITH ") + """, named AS (SELECT *, 'r' || start // 86400 // 2 AS region_name FROM runs),
      names AS (SELECT sample, chr, cn_id, string_agg(region_name, ',' ORDER BY start) AS region_names FROM (SELECT sample, chr, cn_id, region_name, min(start) AS start FROM named GROUP BY ALL) GROUP BY ALL),
      spots AS (SELECT r.sample, r.chr, r.cn_id, alt_count / nullif(alt_count + ref_count, 0)::DOUBLE AS x, 2 * baf * (1 - baf) AS w FROM runs r JOIN counted c ON c.sample = r.sample AND c.chr = r.chr AND c.pos // 86400 = r.start // 86400),
      snps AS (SELECT sample, chr, cn_id, sum(x * w) / nullif(sum(w) FILTER (x IS NOT NULL), 0) AS snp_baf, sum(w) AS snp_weight FROM spots GROUP BY ALL)
      SELECT sample, chr, cn_id, cn_pred, start, "end", length, region_names, round(snp_baf, 6) AS snp_baf, round(snp_weight, 6) AS snp_weight FROM rolled JOIN names USING (sample, chr, cn_id) LEFT JOIN snps USING (sample, chr, cn_id)""",
    "rolling_mean_10": V("g_calls") + """ SELECT sample, chr, start, round(CASE WHEN count(*) OVER w = 10 THEN avg(cov) OVER w ELSE 0 END, 6) AS roll_mean, CASE WHEN count(*) OVER w = 10 THEN sum(cov) OVER w ELSE 0 END AS roll_sum
      FROM g_calls WINDOW w AS (PARTITION BY sample, chr ORDER BY start ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING)""",
    "chromosome_extents": V("g_panel") + """ SELECT chr, min(n) AS first, max(n) AS last, (min(n) + max(n)) / 2.0::DOUBLE AS middle FROM (SELECT chr, row_number() OVER (ORDER BY regexp_replace(chr, '[^0-9]', '', 'g')::INT, chr, start, "end") AS n FROM (SELECT DISTINCT chr, start, "end" FROM g_panel)) GROUP BY chr""",
    "central_window_depth": V("g_reads") + """, p AS (SELECT sample, chr, value, row_number() OVER (PARTITION BY sample, chr ORDER BY event_id) AS i, count(*) OVER (PARTITION BY sample, chr) AS n FROM g_reads)
      SELECT sample, chr, round(avg(value) FILTER (n <= 10 OR abs(i - round_even(n / 2.0::DOUBLE, 0)) <= 4), 6) AS depth, max(n) AS n FROM p GROUP BY ALL""",
    "cohort_recurrence": V("g_calls") + """, c AS (SELECT chr, start, "end", cn_pred, count(DISTINCT sample) AS cnv_in_cohort FROM g_calls GROUP BY ALL)
      SELECT sample, chr, start, cn_pred, cnv_in_cohort, n AS samples_in_cohort, CASE WHEN cn_pred <> '2' AND cnv_in_cohort / n::DOUBLE > 0.3 THEN '2' ELSE cn_pred END AS final_cn
      FROM g_calls JOIN c USING (chr, start, "end", cn_pred), (SELECT count(DISTINCT sample) AS n FROM g_calls)""",
    "cohort_antijoin_union": V("g_cov") + " SELECT sample, chr, start, cov_raw, CASE WHEN sample < 's7' THEN 'call' ELSE 'cohort' END AS type FROM g_cov",
    "previous_cohort_freq": V("g_calls") + """, e AS (SELECT chr, start, cn_pred, count(DISTINCT sample) AS n FROM g_calls WHERE sample >= 's7' GROUP BY ALL)
      SELECT sample, chr, start, cn_pred, coalesce(n, 0) AS earlier FROM g_calls LEFT JOIN e USING (chr, start, cn_pred) WHERE sample < 's7'""",
    "control_sample_diff": V("g_cov") + """, d AS (SELECT t.sample, t.chr, t.start, t."end", (t.cov_raw - c.cov_raw) / nullif(c.cov_raw, 0)::DOUBLE AS diff FROM g_cov t JOIN g_cov c USING (chr, start) WHERE c.sample = 's0' AND t.sample <> 's0'),
      o AS (SELECT *, count(*) OVER (PARTITION BY chr, start) AS in_samples FROM d WHERE abs(diff) > 0.9),
      f AS (SELECT *, CASE WHEN start - lag("end") OVER (PARTITION BY sample, chr ORDER BY start) <= 200000 THEN 0 ELSE 1 END AS fresh FROM o),
      g AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY sample, chr ORDER BY start) AS BIGINT) AS stretch FROM f)
      SELECT sample, chr, stretch, min(start) AS start, max("end") AS "end", round(avg(diff), 6) AS mean_diff, round(avg(in_samples), 6) AS mean_in_samples, count(*) AS n_regions FROM g GROUP BY sample, chr, stretch""",
    "sample_comparison": _RUNS + f""" SELECT target, compared, t.chr, t.cn_id AS target_cn_id, c.cn_id AS compared_cn_id, min(t.start) AS start, max(t."end") AS "end", any_value(t.cn_pred::INT - c.cn_pred::INT) AS cn_difference,
      round(median(t.cov), 6) AS target_median, round(median(c.cov), 6) AS compared_median, round(median(t.cov) - median(c.cov), 6) AS median_difference
      FROM {_SPEC} JOIN runs t ON t.sample = target JOIN runs c ON c.sample = compared AND c.chr = t.chr AND c.start = t.start GROUP BY ALL""",
    "comparison_spec_pairs": """SELECT DISTINCT split_part(p, '::', 1) AS target, split_part(p, '::', 2) AS compared FROM (SELECT unnest(string_split('s' || n_nationkey % 3 || '::s' || n_nationkey % 5 || '|s0::' || n_name, '|')) AS p FROM nation)""",
    "tumor_normal_pairs": """WITH s AS (SELECT c_name, c_custkey // 2 AS donor, c_custkey % 2 = 0 AS t FROM customer) SELECT x.donor, x.c_name AS tumor, y.c_name AS normal FROM s x JOIN s y ON x.donor = y.donor AND x.t AND NOT y.t""",
    "grid_completion": V("g_cov") + """, k AS (SELECT * FROM g_cov WHERE cov_raw > 200 AND start // 86400 % 3 <> 0)
      SELECT s.sample, r.chr, r.start, r."end", coalesce(k.cov_raw, 0)::DOUBLE AS cov FROM (SELECT DISTINCT chr, start, "end" FROM k) r CROSS JOIN (SELECT DISTINCT sample FROM k) s LEFT JOIN k ON k.sample = s.sample AND k.chr = r.chr AND k.start = r.start""",
    "segment_to_cn": _PURE + ' SELECT contig, start, "end", log2, cn, ccn, svtype, gt FROM seg',
    "cn_without_purity": _segment_cn("raw") + ' SELECT contig, start, "end", log2, cn, round(ccn, 6) AS ccn, svtype, gt FROM seg',
    "vcf_records": _PURE + """ SELECT concat_ws(chr(9), contig, start, '.', 'N', '<' || svtype || '>', '.', '.',
      concat_ws(';', 'SVTYPE=' || svtype, 'END=' || "end", 'SVLEN=' || ("end" - start + 1), 'LOG_ODDS_RATIO=' || printf('%.6f', log2), 'COPY_NUMBER=' || printf('%.2f', cn), 'CORRECTED_COPY_NUMBER=' || printf('%.2f', ccn), 'PROBES=' || probes, 'BAF=' || printf('%.6f', baf), 'BAF_PROBES=' || sites),
      'GT:CN:CCN:CNQ' || CASE WHEN sites > 0 THEN ':BAF:BAFQ' ELSE '' END, concat_ws(':', gt, printf('%.2f', cn), printf('%.2f', ccn), probes, CASE WHEN sites > 0 THEN printf('%.6f', baf) || ':' || sites END)) AS value FROM probed""",
    "vcf_records_of_depths": _PURE + """ SELECT concat_ws(chr(9), contig, start, '.', 'N', '<' || svtype || '>', '.', '.',
      concat_ws(';', 'SVTYPE=' || svtype, 'END=' || "end", 'SVLEN=' || ("end" - start + 1), 'LOG_ODDS_RATIO=' || printf('%.6f', log2), 'COPY_NUMBER=' || printf('%.2f', cn), 'PROBES=' || probes, 'BAF=' || CASE WHEN probes % 2 = 0 THEN printf('%.6f', baf) ELSE '.' END),
      'GT:CN:CNQ:DP' || CASE WHEN probes % 2 = 0 THEN ':BAF' ELSE '' END, concat_ws(':', gt, printf('%.2f', cn), probes, printf('%.2f', probes * 1.5::DOUBLE), CASE WHEN probes % 2 = 0 THEN printf('%.6f', baf) END)) AS value FROM probed""",
    "small_variant_filters": _FILTERED + " SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, filter, gt, qual_vcf FROM called",
    "small_variant_vcf": _FILTERED + """ SELECT concat_ws(chr(9), chr, pos, '.', ref, alt, qual_vcf, filter,
      concat_ws(';', 'SAMPLE=s_' || l_suppkey % 10, 'TYPE=' || type, 'DP=' || dp, 'END=' || (pos + span), 'VD=' || vd, 'AF=' || af, 'BIAS=' || replace(bias, ';', ':'), 'REFBIAS=' || rfwd || ':' || rrev, 'VARBIAS=' || vfwd || ':' || vrev,
        'PMEAN=' || pmean, 'PSTD=' || pstd, 'QUAL=' || qual, 'SBF=' || sbf, 'ODDRATIO=' || odds0, 'MQ=' || mapq, 'SN=' || sn, 'HIAF=' || hiaf, 'MSI=' || msi, 'MSILEN=' || msilen, 'NM=' || nm, 'HICNT=' || hicnt,
        CASE WHEN ampflag IS NOT NULL THEN 'GDAMP=' || gamp || ';TLAMP=' || tamp || ';NCAMP=' || ncamp || ';AMPFLAG=' || ampflag ELSE 'DUPRATE=' || gamp || ';CRISPR=' || ncamp || ';SPLITREAD=0;SPANPAIR=0' END),
      'GT:DP:VD:AD:AF:RD:ALD', concat_ws(':', gt, dp, vd, (rfwd + rrev) || ',' || vd, af, rfwd || ',' || rrev, vfwd || ',' || vrev)) AS value FROM called""",
    "every_variant_once": _SMALL + """ SELECT chr, pos AS start, pos + span AS "end", ref, alt, af, l_partkey, l_suppkey, l_linenumber FROM w
      QUALIFY row_number() OVER (PARTITION BY chr, pos, span, ref, alt ORDER BY af DESC, l_partkey, l_suppkey, l_linenumber, l_extendedprice) = 1""",
    "best_variant_per_pos": """SELECT chr, pos, af, l_partkey, l_suppkey, l_linenumber FROM (SELECT l_returnflag AS chr, l_orderkey AS pos, l_discount AS af, l_partkey, l_suppkey, l_linenumber,
      row_number() OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY l_discount DESC, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS n FROM lineitem) WHERE n = 1""",
    "cluster_filter": """WITH RECURSIVE v AS (SELECT o_orderstatus AS chr, o_orderkey AS pos, CASE WHEN o_orderkey % 7 = 0 THEN 'Deletion' ELSE 'SNV' END AS type, CASE WHEN o_totalprice > 200000 THEN 'PASS' ELSE 'q22.5' END AS filter FROM orders),
      e AS (SELECT chr, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY chr ORDER BY pos) < 7 THEN 0 ELSE 1 END AS fresh FROM v WHERE filter = 'PASS' AND type = 'SNV'),
      i AS (SELECT chr, pos, sum(fresh) OVER (PARTITION BY chr ORDER BY pos) AS island FROM e),
      k AS (SELECT *, row_number() OVER (PARTITION BY chr, island ORDER BY pos) AS k FROM i),
      walk(chr, island, k, pos, anchor, clustered) AS (SELECT chr, island, k, pos, pos, false FROM k WHERE k = 1
        UNION ALL SELECT n.chr, n.island, n.k, n.pos, CASE WHEN n.pos - w.anchor < 7 THEN w.anchor ELSE n.pos END, n.pos - w.anchor < 7 FROM walk w JOIN k n ON n.chr = w.chr AND n.island = w.island AND n.k = w.k + 1),
      m AS (SELECT v.*, coalesce(clustered, false) AS c FROM v LEFT JOIN walk USING (chr, pos))
      SELECT chr, pos, type, CASE WHEN c OR coalesce(lead(c) OVER (PARTITION BY chr ORDER BY pos), false) THEN 'Cluster7bp' ELSE filter END AS filter FROM m""",
    "annotation_filter": "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_quantity::INT > 40 AND l_discount >= 0.05",
    "typed_line_filter": """SELECT value FROM (SELECT p_partkey || chr(9) || 'TYPE=' || list_extract(['SNV', 'DUP', 'INV', 'DEL', 'Insertion'], (1 + p_size % 5)::INT) AS value FROM part) WHERE NOT regexp_matches(value, 'TYPE=[DI][UNE][PVL]')""",
    "reciprocal_overlap_merge": "WITH RECURSIVE " + _svs("s") + f""", e AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON {_RECIPROCAL} AND a.id <> b.id),
      r(id, root) AS (SELECT id, id FROM s UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.root) SELECT id, min(root) AS "group" FROM r GROUP BY id""",
    "sv_population_frequency": "WITH " + _svs("s") + ", " + _svs("t", 25) + f""", c AS (SELECT id, chr, start, "end", svtype FROM s WHERE p_size % 3 <> 0), d AS (SELECT * FROM t WHERE p_size % 3 = 0),
      m AS (SELECT a.id, b.p_size AS ac, row_number() OVER (PARTITION BY a.id ORDER BY least(a."end", b."end") - greatest(a.start, b.start) DESC, b.id) AS n FROM c a JOIN d b ON {_RECIPROCAL})
      SELECT c.*, ac::BIGINT AS ac, ac / 100.0::DOUBLE AS freq FROM c LEFT JOIN m ON m.id = c.id AND m.n = 1""",
    "multi_caller_regions": "WITH " + _svs("s") + ", " + _svs("t", 25) + """ SELECT a.id, array_to_string(list_sort(list(DISTINCT b.p_name)), ',') AS region_names, count(*) AS n_regions
      FROM s a JOIN t b ON a.chr = b.chr AND a.start <= b."end" AND b.start <= a."end" WHERE a.p_size % 3 <> 0 AND b.p_size % 3 = 0 GROUP BY a.id""",
    "genotype_class_posterior": _ALLELES + """, h AS (SELECT *, 2 * baf * (1 - baf) AS het FROM counted),
      s AS (SELECT sample, site, i, CASE WHEN alt_count = 0 THEN 0 WHEN p > 0 THEN alt_count * ln(p) ELSE -1e9 END + CASE WHEN ref_count = 0 THEN 0 WHEN p < 1 THEN ref_count * ln(1 - p) ELSE -1e9 END AS score,
        CASE i WHEN 3 THEN het - 2 * het * 0.005::DOUBLE / 3 - 2 * het * 0.01::DOUBLE / 2 WHEN 0 THEN (1 - het) / 2 WHEN 6 THEN (1 - het) / 2 WHEN 2 THEN het * 0.01::DOUBLE / 2 WHEN 4 THEN het * 0.01::DOUBLE / 2 ELSE het * 0.005::DOUBLE / 3 END AS prior
        FROM h, (VALUES (0, 0.0::DOUBLE), (1, 0.25), (2, 0.33), (3, 0.5), (4, 0.66), (5, 0.75), (6, 1.0)) c(i, p)),
      t AS (SELECT sample, site, i, prior * exp(score - max(score) OVER (PARTITION BY sample, site)) AS x FROM s),
      u AS (SELECT sample, site, i, x / nullif(sum(x) OVER (PARTITION BY sample, site), 0) AS x FROM t),
      g AS (SELECT sample, site, sum(x) FILTER (i IN (0, 6)) AS hom, sum(x) FILTER (i = 3) AS p, sum(x) FILTER (i IN (2, 4)) AS tri FROM u GROUP BY ALL)
      SELECT sample, site, round(alt_count / nullif(cov, 0)::DOUBLE, 6) AS vaf, round(hom, 6) AS hom_prob, round(p - 2 * het * 0.005::DOUBLE / 3, 6) AS het_prob, round(tri, 6) AS tri_prob, round(4 * het * 0.005::DOUBLE / 3, 6) AS quad_prob FROM g JOIN h USING (sample, site)""",
    "transition_cost_table": f"""WITH w(i, s, w) AS (VALUES {_W}), p AS (SELECT i, s, w / (SELECT sum(w) FROM w) AS p FROM w), top AS (SELECT max(p) AS top FROM p),
      raw AS (SELECT f.s AS source, t.s AS target, t.p AS prior, CASE WHEN f.s = '2' THEN t.p WHEN f.s = t.s THEN top WHEN t.s = '2' THEN 1 / 7.0::DOUBLE ELSE t.p END AS m FROM p f, p t, top),
      normed AS (SELECT source, target, prior, m / sum(m) OVER (PARTITION BY source) AS p FROM raw), near AS (SELECT DISTINCT dist, 1 - 1 / (1 + exp(-(dist::DOUBLE - 50000) / 10000)) AS t FROM (
        SELECT p_partkey * 1000 - lag(p_partkey * 1000 + p_size * 100) OVER (PARTITION BY p_brand ORDER BY p_partkey * 1000, p_partkey * 1000 + p_size * 100) AS dist FROM part) WHERE dist IS NOT NULL)
      SELECT dist, source, target, round(p, 6) AS p, round(-ln(t * p + (1 - t) * prior), 6) AS cost FROM normed, near""",
    "axis_percentile": _PURE + """, ranked AS (SELECT contig, list_extract(list_sort(list(abs(cn - 2)) FILTER (cn IS NOT NULL)), floor(count(cn) * 0.99::DOUBLE)::INT) AS v FROM seg GROUP BY contig)
      SELECT contig, ceil(greatest(0, v))::BIGINT AS axis_limit_0, ceil(greatest(15, v))::BIGINT AS axis_limit_15 FROM ranked""",
}
SQL["evidence_sum"] = (
    _NB
    + ", "
    + _snp().removeprefix("WITH ")
    + """, placed AS (SELECT c.sample, h.chr, h.pos // 86400 * 86400 AS start, c.state, c.nll FROM snp_costs c JOIN hom h USING (sample, site)),
  every AS (SELECT sample, chr, start, state, nll FROM costs UNION ALL SELECT p.* FROM placed p SEMI JOIN g_bins USING (chr, start))
  SELECT sample, chr, start, state::INT AS state, round(sum(nll), 4) AS nll FROM every GROUP BY ALL"""
)
SQL["interval_fusion"] = V("g_cov") + ' SELECT sample, chr, start // 86400 // 3 AS "group", min(start) AS start, max("end") AS "end", CAST(sum(cov_raw) AS BIGINT) AS cov_raw FROM g_cov GROUP BY sample, chr, start // 86400 // 3'
SQL["cohort_region_join"] = V("g_cov") + " SELECT sample, chr, start, chr || '_' || start AS region_name, start + 1 AS region_id, cov_raw FROM g_cov WHERE start // 86400 % 4 <> 0"
SQL["nb_copy_states"] = (
    V("g_cov")
    + """, m AS (SELECT sample, chr, start, cov_raw::DOUBLE AS k, avg(cov_raw) OVER (PARTITION BY sample) AS m, var_samp(cov_raw) OVER (PARTITION BY sample) AS v FROM g_cov),
  h AS (SELECT sample, chr, start, k, c, CASE WHEN c = 0 THEN 1.0 ELSE m * h END AS mu, CASE WHEN c = 0 THEN 0.1 ELSE m * m / greatest(v - m, 1e-6 * m) * h * h END AS r FROM m, (VALUES (0, 0.0::DOUBLE), (1, 0.5), (2, 1.0), (3, 1.5), (4, 2.0)) x(c, h)),
  p AS (SELECT sample, chr, start, c, exp(lgamma(k + r) - lgamma(r) - lgamma(k + 1) + r * ln(r / (r + mu)) + k * ln(mu / (r + mu))) AS p FROM h)
  SELECT sample, chr, start, c::INT AS copies, round(coalesce(p / nullif(sum(p) OVER (PARTITION BY sample, chr, start), 0), 0), 6) AS p FROM p"""
)
SQL["genome_binning_overlap"] = _bins(5000) + ' SELECT chr, start, "end", ordinal FROM binned'
SQL["depth_of_any_regions"] = (
    V("g_reads", "g_panel")
    + """, p AS (SELECT DISTINCT list_extract(['click','error','purchase','signup','view'], (1 + ordinal % 5)::INT) AS chr, start, "end" FROM g_panel)
  SELECT s.sample, p.chr, p.start, p."end", count(r.event_id) AS n_reads FROM p CROSS JOIN (SELECT DISTINCT sample FROM g_reads) s
  LEFT JOIN g_reads r ON r.sample = s.sample AND r.chr = p.chr AND r.pos <= p."end" AND r.pos + 3600 >= p.start GROUP BY ALL"""
)
SQL["autosome_filter"] = "SELECT p_partkey AS id, 'chr' || p_size % 30 AS chr FROM part WHERE p_size % 30 BETWEEN 1 AND 22"
SQL["cohort_mean_norm"] = V("g_cov") + " SELECT sample, chr, start, round(cov_raw / avg(cov_raw) OVER (PARTITION BY sample) * (SELECT avg(cov_raw) FROM g_cov WHERE sample >= 's7'), 6) AS cov FROM g_cov WHERE sample < 's7'"
_R = V("g_cov") + ", r AS (SELECT x.sample AS a, y.sample AS b, corr(x.cov_raw, y.cov_raw) AS r FROM g_cov x JOIN g_cov y USING (chr, start) GROUP BY ALL)"
SQL["norm_weights"] = _R + " SELECT a AS sample, round(sum(CASE WHEN a = b THEN 1.0 ELSE greatest(0, coalesce(r, 0)) END), 6) AS norm_weight FROM r GROUP BY a"
SQL["similarity_weights"] = (
    _R
    + """, w AS (SELECT a, b, CASE WHEN a = b THEN 1.0 ELSE coalesce(pow(greatest(r, 0), 8), 0) END AS w FROM r),
  n AS (SELECT a, b, CAST(round_even(w / sum(w) OVER (PARTITION BY a) * 1000, 0) AS BIGINT) AS weight FROM w)
  SELECT a AS target, b AS sample, chr, start, weight, count(*) OVER (PARTITION BY a, chr, start) AS n FROM n JOIN g_cov ON g_cov.sample = b WHERE weight > 0"""
)
SQL["too_frequent_calls"] = (
    V("g_calls")
    + """, c AS (SELECT chr, start, cn_pred, count(DISTINCT sample) AS cnv_in_cohort FROM g_calls GROUP BY ALL)
  SELECT sample, chr, start, cn_pred, cnv_in_cohort, n AS samples_in_cohort, '2' AS final_cn FROM g_calls JOIN c USING (chr, start, cn_pred), (SELECT count(DISTINCT sample) AS n FROM g_calls)
  WHERE sample < 's7' AND cn_pred <> '2' AND cnv_in_cohort / n::DOUBLE > 0.3"""
)
SQL["cohort_info"] = V("g_calls") + ' SELECT sample, chr, start, "end", cn_pred, cov_raw, cov FROM g_calls'
SQL["control_sample_stretches"] = SQL["control_sample_diff"] + " HAVING max(\"end\") - min(start) > 200000 AND avg(in_samples) <> 3"


def _numbers(values) -> str:
    return "[" + ", ".join(f"{float(x)!r}::DOUBLE" for x in values) + "]"


def _viterbi(states: tuple = STATES, tag: str = "") -> str:
    """From costs{tag} (sample, chr, start, state, nll) and g_bins: decoded{tag} (sample, chr, start, cn_pred, chr_cost), by recursion along the regions and back."""
    k, p, m = len(states), prior(states), transitions(states)
    names = "[" + ", ".join(f"'{x}'" for x in states) + "]"
    table = "[" + ", ".join(_numbers(row) for row in m) + "]"
    step = f"w.totals[i] - ln(w.t * {table}[i][j] + (1 - w.t) * {_numbers(p)}[j])"
    return f"""steps{tag} AS (
  SELECT sample, chr, start, row_number() OVER (PARTITION BY sample, chr ORDER BY start) AS k, list(nll ORDER BY state) AS nll,
         1 - 1 / (1 + exp(-(coalesce(lead(start) OVER (PARTITION BY sample, chr ORDER BY start) - min("end"), 0)::DOUBLE - {DISTANCE!r}::DOUBLE) / {DISTANCE_SCALE!r}::DOUBLE)) AS t
  FROM costs{tag} JOIN g_bins USING (chr, start) GROUP BY sample, chr, start),
walk{tag}(sample, chr, k, start, t, totals, backs) AS (
  SELECT sample, chr, k, start, t, list_transform(range(1, {k + 1}), lambda j: nll[j] - ln({_numbers(p)}[j])), CAST([] AS BIGINT[]) FROM steps{tag} WHERE k = 1
  UNION ALL
  SELECT sample, chr, k, start, t, list_transform(range(1, {k + 1}), lambda j: list_min(ways[j]) + nll[j]), list_transform(range(1, {k + 1}), lambda j: list_position(ways[j], list_min(ways[j])))
  FROM (SELECT n.sample, n.chr, n.k, n.start, n.t, n.nll, list_transform(range(1, {k + 1}), lambda j: list_transform(range(1, {k + 1}), lambda i: {step})) AS ways
        FROM walk{tag} w JOIN steps{tag} n ON n.sample = w.sample AND n.chr = w.chr AND n.k = w.k + 1)),
ends{tag} AS (SELECT sample, chr, max(k) AS k FROM walk{tag} GROUP BY ALL),
path{tag}(sample, chr, k, start, state, backs) AS (
  SELECT w.sample, w.chr, w.k, w.start, list_position(w.totals, list_min(w.totals)), w.backs FROM walk{tag} w JOIN ends{tag} e ON e.sample = w.sample AND e.chr = w.chr AND e.k = w.k
  UNION ALL
  SELECT w.sample, w.chr, w.k, w.start, q.backs[q.state], w.backs FROM path{tag} q JOIN walk{tag} w ON w.sample = q.sample AND w.chr = q.chr AND w.k = q.k - 1),
decoded{tag} AS (
  SELECT path{tag}.sample, path{tag}.chr, path{tag}.start, {names}[state] AS cn_pred, c.chr_cost FROM path{tag}
  JOIN (SELECT w.sample, w.chr, list_min(w.totals) AS chr_cost FROM walk{tag} w JOIN ends{tag} e ON e.sample = w.sample AND e.chr = w.chr AND e.k = w.k) c ON c.sample = path{tag}.sample AND c.chr = path{tag}.chr)"""


def _recursive(sql: str) -> str:
    return "WITH RECURSIVE " + sql.removeprefix("WITH ")


_DECODED = _recursive(_NB + ", " + _viterbi())
SQL["viterbi_decode"] = _DECODED + ' SELECT d.sample, d.chr, d.start, c."end", c.cov_raw::DOUBLE AS cov, d.cn_pred, round(d.chr_cost, 4) AS chr_cost FROM decoded d JOIN g_cov c USING (sample, chr, start)'
SQL["sample_path_cost"] = _DECODED + " SELECT sample, round(sum(chr_cost), 4) AS cost FROM (SELECT DISTINCT sample, chr, chr_cost FROM decoded) GROUP BY sample"
SQL["greedy_region_groups"] = _recursive(
    V("g_panel")
    + """, o AS (SELECT chr, start, "end", row_number() OVER (PARTITION BY chr ORDER BY start, "end") AS k FROM g_panel),
  walk(chr, k, start, "end", first, n) AS (
    SELECT chr, k, start, "end", start, 1 FROM o WHERE k = 1
    UNION ALL
    SELECT o.chr, o.k, o.start, o."end", CASE WHEN o."end" - w.first > 100000 THEN o.start ELSE w.first END, w.n + CASE WHEN o."end" - w.first > 100000 THEN 1 ELSE 0 END FROM walk w JOIN o ON o.chr = w.chr AND o.k = w.k + 1)
  SELECT chr, start, "end", n::INT AS "group" FROM walk"""
)
#: Coverage with the changes that the caller's query plants, normalised, with its moments over similar samples.
_PANEL = V("g_cov") + """, planted AS (
  SELECT sample, chr, start, "end", CAST(CASE WHEN sample = 's3' AND chr = 'view' AND start // 86400 BETWEEN 10 AND 19 THEN (cov_raw + 2000) * 2
    WHEN sample = 's7' AND chr = 'click' AND start // 86400 BETWEEN 3 AND 12 THEN (cov_raw + 2000) // 2 ELSE cov_raw + 2000 END AS BIGINT) AS cov_raw FROM g_cov),
scaled AS (SELECT sample, chr, start, "end", cov_raw / avg(cov_raw) OVER (PARTITION BY sample) * (SELECT avg(cov_raw) FROM planted) AS cov FROM planted),
related AS (SELECT x.sample AS a, y.sample AS b, corr(x.cov, y.cov) AS r FROM scaled x JOIN scaled y USING (chr, start) GROUP BY ALL),
alike AS (SELECT a, b, CASE WHEN a = b THEN 1.0 ELSE greatest(0, coalesce((r + 1) / 2, 0)) END AS w FROM related),
met AS (SELECT a, chr, start, cov, w, sum(cov * w) OVER (PARTITION BY a, chr, start) / sum(w) OVER (PARTITION BY a, chr, start) AS m FROM alike JOIN scaled ON scaled.sample = b WHERE w > 0),
moments AS (SELECT a AS sample, chr, start, min(m) AS m, coalesce(sqrt(sum(w * (cov - m) * (cov - m)) / nullif((count(*) - 1) / count(*)::DOUBLE * sum(w), 0)), 1.0) AS sd FROM met GROUP BY ALL)"""
_CALLED = tuple(s for s in STATES if s != "LOH")
SQL["cnv_caller_end_to_end"] = _recursive(
    _PANEL
    + f""", z AS (SELECT s.sample, s.chr, s.start, state, abs((cov - m * half) / nullif(sd, 0)) / sqrt(2.0::DOUBLE) AS y FROM scaled s JOIN moments USING (sample, chr, start), {_COPIES} WHERE state < 6),
  nb AS (SELECT sample, chr, start, state, 0 AS bonus, {_ERF_T} * ({_A1} + {_ERF_T} * ({_A2} + {_ERF_T} * ({_A3} + {_ERF_T} * ({_A4} + {_ERF_T} * {_A5})))) * exp(-y * y) AS p FROM z),
  {_costs("nb", "sample, chr, start")},
  {_viterbi(_CALLED)},
  shared AS (SELECT chr, start, cn_pred, count(DISTINCT sample) AS n FROM decoded GROUP BY ALL),
  final AS (SELECT d.sample, d.chr, d.start, s."end", s.cov, (s.cov - m.m) / nullif(m.sd, 0) AS sd_distance,
      CASE WHEN d.cn_pred <> '2' AND c.n / (SELECT count(DISTINCT sample) FROM decoded)::DOUBLE > 0.9 THEN '2' ELSE d.cn_pred END AS cn_pred
    FROM decoded d JOIN scaled s USING (sample, chr, start) JOIN moments m USING (sample, chr, start) JOIN shared c ON c.chr = d.chr AND c.start = d.start AND c.cn_pred = d.cn_pred),
  flagged AS (SELECT *, CASE WHEN cn_pred = lag(cn_pred) OVER w THEN 0 ELSE 1 END AS fresh, CASE WHEN start - lag("end") OVER w > 200000 THEN 1 ELSE 0 END AS gap FROM final WINDOW w AS (PARTITION BY sample, chr ORDER BY start)),
  runs AS (SELECT *, sum(fresh) OVER w AS cn_id, sum(gap) OVER w AS group_id FROM flagged WINDOW w AS (PARTITION BY sample, chr ORDER BY start))
  SELECT sample, chr, arg_min(cn_pred, start) AS cn_pred, min(start) AS start, max("end") AS "end", max("end") - min(start) AS length, count(*) AS n_regions, round(median(cov), 4) AS median_cov, round(median(sd_distance), 4) AS median_sd_distance
  FROM runs GROUP BY sample, chr, cn_id, group_id HAVING arg_min(cn_pred, start) <> '2'"""
)


def _digamma(x: str) -> str:
    z = f"({x} + 8)"
    shift = " - ".join(f"1 / ({x} + {i})" for i in range(8))
    return f"(ln({z}) - 0.5 / {z} - (1 / 12.0::DOUBLE - (1 / 120.0::DOUBLE - 1 / (252 * {z} * {z})) / ({z} * {z})) / ({z} * {z}) - {shift})"


def _nb_fit(i: int) -> str:
    """From a histogram h{i} (v, n): f{i} (size, mean), the size where the likelihood's slope is 0 by bisection."""
    r = "exp((low + high) / 2)"
    return f"""m{i} AS (SELECT sum(v * n) / sum(n) AS mean, sum(v * v * n) / sum(n) - pow(sum(v * n) / sum(n), 2) AS variance FROM h{i}),
  b{i}(step, low, high) AS (
    SELECT 0, -12.0::DOUBLE, 20.0::DOUBLE
    UNION ALL
    SELECT step + 1, CASE WHEN s > 0 THEN (low + high) / 2 ELSE low END, CASE WHEN s > 0 THEN high ELSE (low + high) / 2 END
    FROM (SELECT step, low, high, sum(n * ({_digamma(f"(v + {r})")} - {_digamma(r)} + ln({r} / ({r} + mean)))) AS s FROM b{i}, h{i}, m{i} WHERE step < 100 GROUP BY step, low, high)),
  f{i} AS (SELECT CASE WHEN variance <= mean THEN 'infinity'::DOUBLE ELSE {r} END AS size, mean FROM b{i}, m{i} WHERE step = 100)"""


def _nb_limits(i: int, p: float, most: int = 100_000) -> str:
    """q{i} (low, high): the p and 1 - p quantiles of f{i}."""
    return f"""q{i} AS (SELECT min(k) FILTER (c >= {p}::DOUBLE) AS low, min(k) FILTER (c >= 1 - {p}::DOUBLE) AS high FROM (
    SELECT k, sum(exp(CASE WHEN isinf(size) THEN k * ln(mean) - mean - lgamma(k + 1) ELSE lgamma(k + size) - lgamma(size) - lgamma(k + 1) + size * ln(size / (size + mean)) + k * ln(mean / (size + mean)) END)) OVER (ORDER BY k) AS c FROM f{i}, range({most}) t(k)))"""


SQL["nb_fit"] = _recursive(
    V("g_cov")
    + ", h0 AS (SELECT cov_raw::DOUBLE AS v, count(*)::DOUBLE AS n FROM g_cov GROUP BY 1), "
    + ", ".join(f"{_nb_fit(i)}, {_nb_limits(i, 0.1)}, h{i + 1} AS (SELECT h{i}.* FROM h{i}, q{i} WHERE v > low AND v < high)" for i in range(6))
    + f", {_nb_fit(6)} SELECT round(size, 4) AS size, round(mean, 4) AS mean, (SELECT sum(n)::BIGINT FROM h6) AS n_used FROM f6"
)
_IN = ["true", "med > (SELECT low FROM q0) AND med < (SELECT high FROM q0)"]
SQL["outlier_regions"] = _recursive(
    V("g_cov")
    + ", k AS (SELECT *, median(cov_raw) OVER (PARTITION BY chr, start) AS med FROM g_cov), "
    + ", ".join(f"h{i} AS (SELECT cov_raw::DOUBLE AS v, count(*)::DOUBLE AS n FROM k WHERE {_IN[i]} GROUP BY 1), {_nb_fit(i)}, {_nb_limits(i, 0.1)}" for i in range(2))
    + """, q AS (SELECT greatest(a.low, b.low) AS low, least(a.high, b.high) AS high FROM q0 a, q1 b)
  SELECT sample, chr, start, cov_raw, NOT (med > low AND med < high) AS outlier FROM k, q"""
)
SQL["fisher_strand_bias"] = """WITH RECURSIVE l AS (SELECT l_orderkey, l_quantity::BIGINT % 13 AS rfwd, l_partkey % 11 AS rrev, l_linenumber::BIGINT AS vfwd, l_suppkey % 7 AS vrev FROM lineitem),
  t AS (SELECT DISTINCT rfwd, rrev, vfwd, vrev, rfwd + rrev AS r, rfwd + vfwd AS c, rfwd + rrev + vfwd + vrev AS total FROM l),
  u AS (SELECT *, row_number() OVER () AS id, greatest(0, c - (total - r)) AS low, least(r, c) AS high FROM t),
  x AS (SELECT id, rfwd, low, high, unnest(range(low, high + 1)) AS x, r, c, total FROM u),
  g AS (SELECT id, rfwd, low, high, x, -lgamma(x + 1) - lgamma(r - x + 1) - lgamma(c - x + 1) - lgamma(total - r - c + x + 1) AS lh FROM x),
  h AS (SELECT id, rfwd, x, exp(lh - max(lh) OVER (PARTITION BY id)) AS h FROM g),
  s AS (SELECT id, max(h) FILTER (x = rfwd) AS own FROM h GROUP BY id),
  p AS (SELECT h.id, least(1.0, sum(h) FILTER (h <= own * (1 + 1e-7::DOUBLE)) / sum(h)) AS p FROM h JOIN s USING (id) GROUP BY h.id),
  open AS (SELECT id, rfwd, x, lh FROM g WHERE rfwd > low AND rfwd < high),
  walk(id, step, lo, hi) AS (
    SELECT DISTINCT id, 0, -60.0::DOUBLE, 60.0::DOUBLE FROM open
    UNION ALL
    SELECT id, step + 1, CASE WHEN below THEN mid ELSE lo END, CASE WHEN below THEN hi ELSE mid END
    FROM (SELECT w.id, w.step, w.lo, w.hi, (w.lo + w.hi) / 2 AS mid,
            sum(x * exp(lh + x * (w.lo + w.hi) / 2 - peak)) / sum(exp(lh + x * (w.lo + w.hi) / 2 - peak)) < any_value(rfwd) AS below
          FROM (SELECT v.id, v.step, v.lo, v.hi, o.x, o.rfwd, o.lh, max(o.lh + o.x * (v.lo + v.hi) / 2) OVER (PARTITION BY v.id) AS peak FROM walk v JOIN open o ON o.id = v.id WHERE v.step < 80) w
          GROUP BY w.id, w.step, w.lo, w.hi)),
  done AS (SELECT id, exp((lo + hi) / 2) AS odds FROM walk WHERE step = 80)
  SELECT l_orderkey, l.rfwd, l.rrev, l.vfwd, l.vrev, round(p, 5) AS p, CASE WHEN u.low = u.high THEN NULL WHEN u.rfwd = u.low THEN 0 WHEN u.rfwd = u.high THEN 'infinity'::DOUBLE ELSE round(odds, 5) END AS odds_ratio
  FROM l JOIN u ON u.rfwd = l.rfwd AND u.rrev = l.rrev AND u.vfwd = l.vfwd AND u.vrev = l.vrev JOIN p USING (id) LEFT JOIN done USING (id)"""


def _somatic_round(i: int, last: bool) -> str:
    """From load{i} (sample, load): the states of the round, and unless it is the last the next loads."""
    genotypes = ", ".join(f"({STATES.index(s)}, {copies}, {variant}, {w!r}::DOUBLE)" for s, copies, variant, w in GENOTYPES)
    found = f"""z{i} AS (SELECT s.sample, s.chr, s.start, state, abs((cov - m * (load * half + 1 - load)) / nullif(sd, 0)) / sqrt(2.0::DOUBLE) AS y FROM scaled s JOIN moments USING (sample, chr, start) JOIN load{i} USING (sample), {_COPIES}),
  nb{i} AS (SELECT sample, chr, start, state, 0 AS bonus, {_ERF_T} * ({_A1} + {_ERF_T} * ({_A2} + {_ERF_T} * ({_A3} + {_ERF_T} * ({_A4} + {_ERF_T} * {_A5})))) * exp(-y * y) AS p FROM z{i}),
  {_costs(f"nb{i}", "sample, chr, start").replace("one AS", f"one{i} AS").replace("FROM one)", f"FROM one{i})").replace("two AS", f"two{i} AS").replace("FROM two)", f"FROM two{i})").replace("costs AS", f"covered{i} AS")},
  expected{i} AS (SELECT sample, state, ln(w) AS lw, ((1 - load) + load * variant) / (2 * (1 - load) + load * copies) AS e FROM load{i}, (VALUES {genotypes}) g(state, copies, variant, w)),
  score{i} AS (SELECT c.sample, c.site, x.state, max(lw + CASE WHEN alt_count = 0 THEN 0 WHEN e > 0 THEN alt_count * ln(e) ELSE -1e9 END + CASE WHEN ref_count = 0 THEN 0 WHEN e < 1 THEN ref_count * ln(1 - e) ELSE -1e9 END) AS score
    FROM spots c JOIN expected{i} x USING (sample) GROUP BY ALL),
  best{i} AS (SELECT sample, site, state, exp(score - max(score) OVER (PARTITION BY sample, site)) AS p FROM score{i}),
  first{i} AS (SELECT sample, site, state, p / sum(p) OVER (PARTITION BY sample, site) + {_FLOOR} AS p FROM best{i}),
  second{i} AS (SELECT sample, site, state, p / sum(p) OVER (PARTITION BY sample, site) AS p FROM first{i}),
  mixed{i} AS (SELECT sample, site, chr, start, state, het * p + (1 - het) * h AS p FROM second{i} JOIN spots USING (sample, site)),
  sited{i} AS (SELECT sample, chr, start, state, -ln(p / sum(p) OVER (PARTITION BY sample, site)) AS nll FROM mixed{i}),
  costs_{i} AS (SELECT sample, chr, start, state, sum(nll) AS nll FROM (SELECT * FROM covered{i} UNION ALL SELECT * FROM sited{i}) GROUP BY ALL),
  {_viterbi(tag=f"_{i}")}"""
    if last:
        return found
    return (
        found
        + f""",
  changed{i} AS (SELECT d.*, s."end", s.cov, CASE WHEN d.cn_pred = lag(d.cn_pred) OVER (PARTITION BY d.sample, d.chr ORDER BY d.start) THEN 0 ELSE 1 END AS fresh FROM decoded_{i} d JOIN scaled s USING (sample, chr, start)),
  runs{i} AS (SELECT *, sum(fresh) OVER (PARTITION BY sample, chr ORDER BY start) AS cn_id FROM changed{i}),
  rolled{i} AS (SELECT sample, chr, cn_id, arg_min(cn_pred, start) AS cn_pred, min(start) AS start, max("end") - min(start) AS length, median(cov) AS median_cov FROM runs{i} GROUP BY ALL),
  top{i} AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY length DESC, chr, start) AS place FROM rolled{i} WHERE cn_pred <> '2'),
  level{i} AS (SELECT sample, median(CASE WHEN cn_pred = 'LOH' THEN cov WHEN cn_pred <> '0' THEN cov / (cn_pred::DOUBLE / 2) WHEN cov > 0 THEN 'infinity'::DOUBLE END) AS norm_cov FROM runs{i} GROUP BY sample),
  implied{i} AS (SELECT sample, length, CASE WHEN cn_pred <> 'LOH' THEN (median_cov / nullif(norm_cov, 0) - 1) / nullif(try_cast(cn_pred AS DOUBLE) / 2 - 1, 0) END AS x FROM top{i} JOIN level{i} USING (sample) WHERE place <= 3),
  load{i + 1} AS (SELECT sample, CASE WHEN count(x) > 0 THEN greatest(least(0.99, sum(x * length) FILTER (x IS NOT NULL) / sum(length) FILTER (x IS NOT NULL)), 0) ELSE 0.1 END AS load FROM load{i} LEFT JOIN implied{i} USING (sample) GROUP BY sample)"""
    )


SQL["cnv_caller_somatic"] = _recursive(
    _PANEL
    + ", "
    + _ALLELES.removeprefix("WITH ")
    + f""", spots AS (
    SELECT sample, site, chr, pos // 86400 * 86400 AS start, alt_count, ref_count, 2 * baf * (1 - baf) AS het, greatest({_beta("alt_count", "ref_count")}, {_beta("ref_count", "alt_count")}) AS h
    FROM counted WHERE site IN (SELECT site FROM counted GROUP BY site HAVING max(cov) > 20)),
  load0 AS (SELECT DISTINCT sample, 0.75::DOUBLE AS load FROM scaled),
  {", ".join(_somatic_round(i, i == 2) for i in range(3))},
  final AS (SELECT d.sample, d.chr, d.start, s."end", s.cov, d.cn_pred, (s.cov - m.m) / nullif(m.sd, 0) AS sd_distance FROM decoded_2 d JOIN scaled s USING (sample, chr, start) JOIN moments m USING (sample, chr, start)),
  flagged AS (SELECT *, CASE WHEN cn_pred = lag(cn_pred) OVER w THEN 0 ELSE 1 END AS fresh FROM final WINDOW w AS (PARTITION BY sample, chr ORDER BY start)),
  runs AS (SELECT *, sum(fresh) OVER (PARTITION BY sample, chr ORDER BY start) AS cn_id FROM flagged)
  SELECT sample, chr, arg_min(cn_pred, start) AS cn_pred, min(start) AS start, max("end") AS "end", max("end") - min(start) AS length, count(*) AS n_regions, round(median(cov), 4) AS median_cov, round(median(sd_distance), 4) AS median_sd_distance
  FROM runs GROUP BY sample, chr, cn_id HAVING arg_min(cn_pred, start) <> '2'"""
)

SQL["panel_moments_with_holes"] = V("g_cov") + """, k AS (SELECT sample, chr, start, cov_raw FROM g_cov WHERE (start // 86400 + substr(sample, 2)::INT) % 7 <> 0),
      x AS (SELECT s.sample, p.chr, p.start, coalesce(k.cov_raw, 0) AS x FROM (SELECT DISTINCT sample FROM k) s CROSS JOIN (SELECT DISTINCT chr, start FROM k) p LEFT JOIN k ON k.sample = s.sample AND k.chr = p.chr AND k.start = p.start),
      r AS (SELECT y.sample AS a, z.sample AS b, corr(y.x, z.x) AS r FROM x y JOIN x z USING (chr, start) GROUP BY ALL),
      w AS (SELECT a, b, CASE WHEN a = b THEN 1.0 ELSE greatest(0, coalesce(r, 0)) END AS w FROM r),
      m AS (SELECT a, chr, start, x, w, sum(x * w) OVER (PARTITION BY a, chr, start) / sum(w) OVER (PARTITION BY a, chr, start) AS wm FROM w JOIN x ON x.sample = b WHERE w > 0),
      s AS (SELECT a, chr, start, min(wm) AS wm, sqrt(sum(w * (x - wm) * (x - wm)) / nullif((count(*) - 1) / count(*)::DOUBLE * sum(w), 0)) AS sd FROM m GROUP BY ALL)
      SELECT a AS sample, chr, start, round(wm, 4) AS w_mean, round(CASE WHEN sd IS NULL OR isnan(sd) THEN 1.0 ELSE sd END, 4) AS w_sd FROM s"""
SQL["unified_caller_segments"] = """WITH every AS (
        SELECT p_brand AS chr, CASE WHEN p_size % 2 = 0 THEN 'DEL' ELSE 'DUP' END AS svtype, ['alpha', 'beta', 'gamma'][(1 + p_partkey % 3)::INT] AS caller, p_partkey % 200 * 50 AS start, p_partkey % 200 * 50 + p_size * 20 AS "end",
               p_size % 12 AS cn, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 60 END AS probes, p_partkey % 9 AS weight, CASE WHEN p_partkey % 3 = 1 THEN p_partkey % 10 END AS norm_weight FROM part),
      calls AS (SELECT * FROM every WHERE NOT coalesce(norm_weight <= weight, false) AND cn <> 2 AND (cn < 10 OR probes IS NULL OR probes > 25)),
      edges AS (SELECT chr, svtype, start AS pos FROM calls UNION SELECT chr, svtype, "end" + 1 FROM calls),
      spans AS (SELECT chr, svtype, pos AS start, lead(pos) OVER (PARTITION BY chr, svtype ORDER BY pos) - 1 AS "end" FROM edges),
      held AS (SELECT s.chr, s.svtype, s.start, s."end", string_agg(DISTINCT caller, ',' ORDER BY caller) AS callers, count(DISTINCT caller) AS n FROM spans s JOIN calls c ON c.chr = s.chr AND c.svtype = s.svtype AND c.start <= s.start AND c."end" >= s."end" GROUP BY ALL),
      marked AS (SELECT *, CASE WHEN lag(callers) OVER w = callers AND lag("end") OVER w = start - 1 THEN 0 ELSE 1 END AS fresh FROM held WINDOW w AS (PARTITION BY chr, svtype ORDER BY start)),
      pieces AS (SELECT *, sum(fresh) OVER (PARTITION BY chr, svtype ORDER BY start) AS piece FROM marked)
      SELECT chr, svtype, min(start) AS start, max("end") AS "end", callers, n::INT AS n_callers FROM pieces GROUP BY chr, svtype, piece, callers, n"""

SQL["structural_variant_vcf"] = SQL["small_variant_vcf"].replace("alt, qual_vcf", "shown_alt, qual_vcf").replace("';SPLITREAD=0;SPANPAIR=0'", """CASE WHEN shown_alt LIKE '<%' THEN ';SVTYPE=' || replace(replace(shown_alt, '<', ''), '>', '') || ';SVLEN=' || (span + CASE WHEN shown_alt = '<INV>' THEN 1 ELSE 0 END) ELSE '' END
          || ';SPLITREAD=' || split || ';SPANPAIR=' || pairs""").replace(" AS value FROM called", """ AS value FROM (
      SELECT *, CASE WHEN ampflag IS NULL AND l_orderkey % 3 = 0 THEN CASE WHEN l_partkey % 2 = 0 THEN '<DEL>' ELSE '<INV>' END ELSE alt END AS shown_alt,
             CASE WHEN l_partkey % 7 <> 0 THEN l_suppkey % 3 ELSE 0 END AS split, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey % 5 ELSE 0 END AS pairs FROM called) WHERE shown_alt NOT LIKE '<%' OR split >= 1""")

SQL["annotation_filter_defaults"] = "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE (l_quantity * 2)::INT > 50 AND l_discount / 50 >= 0.001"
