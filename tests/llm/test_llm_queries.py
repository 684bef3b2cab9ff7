"""The queries as they are registered: against their SQL where there is any, else against plain Python."""

import hashlib
import random
import zlib

import duckdb
import pytest

from helixframe.llm import queries, spans

from .fixtures import documents
from .test_quality import brute, brute_bands
from .test_spans import brute_personal, brute_secrets


def long_texts():
    """Texts of some 8,000 words: prose, a near copy, shared lines, one long line, repeats."""
    rng = random.Random(6)
    words = [f"w{rng.randrange(60_000)}" for _ in range(8_000)]
    prose = "\n".join(" ".join(words[i : i + 11]) for i in range(0, len(words), 11))
    near = prose.split("\n")
    near[500] = "another line of this long text altogether"
    return [(1001, prose), (1002, "\n".join(near)), (1003, " ".join(words)), (1004, "x" * 5000), (1005, (prose[:5000] + "\n") * 20)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rows = {r[0]: (r[0], r[1], r[2], r[3], r[4]) for r in documents() if r[0] is not None}
    rows |= {i: (i, t, "en", "b", len(t)) for i, t in long_texts()}
    spark.createDataFrame(list(rows.values()), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, k % 2) for k, i in enumerate(rows)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return str(folder), {i: r[1] or "" for i, r in rows.items()}, con


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_source_mix", "op10_superminhash", "op11_merkle_manifest", "op12_phrase_collocations"])
def test_query_matches_sql(spark, tables, name):
    folder, _, con = tables
    found = queries.queries()[name](spark, folder)
    cursor = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(cursor.fetchall())


def test_quality_query(spark, tables):
    folder, texts, _ = tables
    for r in queries.op3_compression_bands(spark, folder).collect():
        base, (ratio, n, off, inside) = brute(texts[r["doc_id"]]), brute_bands(texts[r["doc_id"]].encode())
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert (r["base_failed"], r["kept"], r["n_chunks"], r["n_chunks_off"], r["ratio"]) == (failed, inside and not failed, n, off, round(ratio, 6))


def test_classifier_query(spark, tables):
    folder, texts, _ = tables
    rows = queries.op4_factorisation_machine(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


@pytest.mark.parametrize("name, found, kinds", [("op5_personal_data", brute_personal, spans.PERSONAL), ("op7_secret_scan", brute_secrets, spans.SECRET)])
def test_span_queries(spark, tables, name, found, kinds):
    folder, texts, _ = tables
    rows = queries.queries()[name](spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        base = found(texts[r["doc_id"]])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(k == own for own, _, _ in base) for k in kinds]
        assert set(written.split(",")) - {""} <= set(r["spans"].split(","))


def test_piece_query(spark, tables):
    folder, texts, _ = tables
    rows = queries.op8_sampled_pieces(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and all(r["lossless"] for r in rows)
