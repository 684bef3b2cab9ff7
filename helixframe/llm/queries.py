"""The queries of this subpackage, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audio_match import fingerprints, match_recordings, sonified
from .collocations import collocations
from .line_dedup import dedup_lines
from .merkle import manifest
from .mixing import mix_sources
from .near_dedup import near_duplicates
from .pii import all_spans, find_personal_data, span_digest, span_text
from .quality_fm import score_quality, train
from .quality_rules import quality_statistics
from .secret_scan import scan_secrets, spans_by_start
from .sentencepiece_sampling import sample_pieces
from .url_filter import judge_urls
from .warc_zip import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
        FROM documents)),
firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, line, pos, first_doc IS NOT NULL AND doc_id > first_doc AS lost
  FROM lines LEFT JOIN firsts USING (key))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS n FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM filled),
targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, n) FROM levels WHERE level <= cap / weight)) AS target FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS until
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed),
parts AS (
  SELECT *, greatest(0, least(size, budget - epochs * source_size - (until - size))) AS part FROM cut)
SELECT doc_id, size, source_size, target, CAST(epochs * size + part AS BIGINT) AS taken,
       CAST(CASE WHEN size > 0 THEN epochs + CASE WHEN part * 2 >= size THEN 1 ELSE 0 END ELSE 0 END AS INTEGER) AS copies
FROM parts
"""


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_statistics(_table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(F.col("doc").alias("doc_id"), *base, "n_bytes", F.round("ratio", 6).alias("ratio"), "n_chunks", "n_chunks_off")


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(docs, _table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(F.col("doc").alias("doc_id"), "held_out", "score", "predicted")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    counts = ["n_email", "n_ip", "n_card", "n_phone"]
    return found.select(F.col("doc").alias("doc_id"), *counts, span_digest("base").alias("base_sha256"), span_text(all_spans("base", "added")).alias("spans"))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archives(write_archives(_table(spark, sf_dir, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
coded AS (
  SELECT page_id, strlen(html) AS n, h,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS digest,
         min(page_id) OVER (PARTITION BY h) AS first
  FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded
"""


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_assign", "n_access", "n_hex", span_digest("base").alias("base_sha256"), span_text(spans_by_start("base", "added")).alias("spans"))


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sample_pieces(_table(spark, sf_dir, "documents"), with_ids=False)
    return found.select(F.col("doc").alias("doc_id"), "n_pieces", "ids_sha256", "lossless")


def op9_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no audio, so each embedding is made a recording; ids divisible by 50 are the queries.

    A row for each recording (match_id null) and one for each pair of classes that align.
    """
    prints = fingerprints(sonified(_table(spark, sf_dir, "embeddings")), "id", "audio")
    members, matches = match_recordings(prints, F.col("id") % 50 == 0)
    none = F.lit(None)
    rows = members.select(F.col("id").alias("vec_id"), "class_id", "n_ints", none.cast("long").alias("match_id"), none.cast("long").alias("offset"), none.cast("double").alias("bit_error"))
    pairs = matches.select(none.cast("long").alias("vec_id"), "class_id", none.cast("long").alias("n_ints"), "match_id", "offset", "bit_error")
    return rows.unionByName(pairs)


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
  WITH RECURSIVE r(doc_id, root) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, links.b FROM r JOIN links ON links.a = r.root)
  SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    found = manifest(_table(spark, sf_dir, "documents"), tampered={"n_chars": F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    return found.select(F.col("doc").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, CAST(length(CAST(doc_id AS VARCHAR)) AS BIGINT) + 1),
              lambda i: [CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS BIGINT), 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS crc
  FROM documents),
fields AS (
  SELECT doc_id, lang, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS tampered, n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM crc),
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(length(CAST(tampered AS VARCHAR)) || ':' || tampered, '-') || tail) AS other
  FROM fields),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM hashed),
tree(grp, level, pos, digest, n) AS (
  SELECT grp, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY grp, level, pos // 2, n),
subroots AS (SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
top(level, pos, digest, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
low(doc_id, grp, leaf, level, pos, n, digest, siblings) AS (
  SELECT doc_id, grp, leaf, 0, pos, n, other, '' FROM leaves
  UNION ALL
  SELECT f.doc_id, f.grp, f.leaf, f.level + 1, f.pos // 2, (f.n + 1) // 2, sha256(CASE WHEN f.pos % 2 = 0 THEN f.digest || coalesce(s.digest, '') ELSE s.digest || f.digest END), f.siblings || coalesce(s.digest, '')
  FROM low f LEFT JOIN tree s ON s.grp = f.grp AND s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1),
high(doc_id, leaf, subroot, level, pos, n, digest, siblings) AS (
  SELECT doc_id, leaf, subroot, 0, r.pos, r.n, digest, siblings FROM low JOIN subroots r USING (grp) WHERE low.n = 1
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.level + 1, f.pos // 2, (f.n + 1) // 2, sha256(CASE WHEN f.pos % 2 = 0 THEN f.digest || coalesce(s.digest, '') ELSE s.digest || f.digest END), f.siblings || coalesce(s.digest, '')
  FROM high f LEFT JOIN top s ON s.level = f.level AND s.pos = xor(f.pos, 1) WHERE f.n > 1)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(siblings) AS proof_sha256, h.digest AS folded_root, h.digest = t.digest AS verified
FROM high h JOIN top t ON t.n = 1 WHERE h.n = 1
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
cuts AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, k FROM f, (SELECT unnest(range(1, 5)) AS k) WHERE k < m),
scored AS (
  SELECT c.lang, c.m, c.phrase, a, k, x.f AS l, y.f AS r, n,
         CAST(1000::HUGEINT * a::HUGEINT * n::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ') JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, f, unnest(list_transform(range(1, m - j + 2), lambda i: array_to_string(string_split(phrase, ' ')[i:i + j - 1], ' '))) AS phrase
  FROM f, (SELECT unnest(range(2, 5)) AS j) WHERE j < m),
kept AS (SELECT * FROM lowest o WHERE NOT EXISTS (SELECT 1 FROM longer g WHERE g.lang = o.lang AND g.phrase = o.phrase AND 100 * g.f >= 100 * o.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "pattern")


OP13_SQL = r"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(action, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
patterns(action, pattern, regex) AS (
  VALUES ('block', '||adult-', '(?i)^([^/]*[.])?adult-'), ('block', '||casino-', '(?i)^([^/]*[.])?casino-'), ('block', '-bets.', '(?i)-bets[.]'), ('block', '||bet.', '(?i)^([^/]*[.])?bet[.]'),
         ('block', '/porn/', '(?i)/porn/'), ('block', '||ads.', '(?i)^([^/]*[.])?ads[.]'), ('block', '/cgi-bin/', '(?i)/cgi-bin/'), ('block', '/wp-login.php|', '(?i)/wp-login[.]php$'), ('block', 'viagra', '(?i)viagra'),
         ('allow', '||casino-museum.', '(?i)^([^/]*[.])?casino-museum[.]'), ('allow', '/adult-education^', '(?i)/adult-education([^a-z0-9_.%-]|$)')),
by_rule AS (
  SELECT page_id, r.host || r.path AS rule, action FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC) = 1),
by_pattern AS (
  SELECT page_id, pattern, action FROM parts p JOIN patterns t ON regexp_matches(p.host || p.path, t.regex)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, action = 'block' DESC, pattern DESC) = 1)
SELECT p.page_id, host, path, rule, coalesce(r.action, t.action, 'allow') AS verdict, CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM parts p LEFT JOIN by_rule r USING (page_id) LEFT JOIN by_pattern t USING (page_id)
"""


def queries() -> dict:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_source_mix": op2_source_mix,
        "op3_compression_bands": op3_compression_bands,
        "op4_factorisation_machine": op4_factorisation_machine,
        "op5_personal_data": op5_personal_data,
        "op6_warc_zip": op6_warc_zip,
        "op7_secret_scan": op7_secret_scan,
        "op8_sampled_pieces": op8_sampled_pieces,
        "op9_chroma_fingerprints": op9_chroma_fingerprints,
        "op10_superminhash": op10_superminhash,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_url_filter": op13_url_filter,
    }


def oracle_sql() -> dict:
    return {"op1_line_dedup": OP1_SQL, "op2_source_mix": OP2_SQL, "op6_warc_zip": OP6_SQL, "op10_superminhash": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op12_phrase_collocations": OP12_SQL, "op13_url_filter": OP13_SQL}
