import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from helixframe.llm import line_dedup, mixing
from helixframe.llm.queries import OP1_SQL, OP2_SQL

from .fixtures import documents, table

SPACES = " \t\n\x0b\x0c\r"


def lower(s):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), s)


def brute_lines(rows):
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(SPACES))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent", [2000, 1])
def test_lines_match_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT_KEYS", frequent)
    monkeypatch.setattr(line_dedup, "SAMPLE_ONE_IN", 1)
    docs = table(spark)
    found = line_dedup.dedup_lines(docs)
    got = sorted(map(tuple, found.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)
    assert got == brute_lines([(r[0], r[1]) for r in documents()])
    assert set(docs.columns) <= set(found.columns)


def test_many_lines_keep_their_bits(spark):
    rows = [(1, "\n".join(f"line number {i}" for i in range(0, 300, 2))), (2, "\n".join(f"line number {i}" for i in range(300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1] == rows[0][1]
    assert got[2] == "\n".join(f"line number {i}" for i in range(1, 300, 2))


def test_empty_tables(spark):
    empty = table(spark, [])
    assert line_dedup.dedup_lines(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0


def plain(spark):
    """Unique ids and no nulls among them, for SQL."""
    return [r for r in documents() if r[0] is not None and r[0] != 18]


def duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [r[:5] for r in rows])
    return con.execute(sql).fetchall()


def test_line_sql(spark):
    rows = plain(spark)
    got = line_dedup.dedup_lines(table(spark, rows)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(duck(rows, OP1_SQL))


def test_mix_sql(spark):
    rows = plain(spark)
    got = mixing.mix_sources(table(spark, rows)).select("doc", "size", "source_size", "target", "taken", "copies").collect()
    want = {r[0]: r[1:] for r in duck(rows, OP2_SQL)}
    assert {r[0]: tuple(r)[1:] for r in got} == {k: pytest.approx(v) for k, v in want.items()}


def test_mix_budgets(spark):
    docs = table(spark)
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(documents())
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
    for rs in by_source.values():
        assert sum(r["taken"] for r in rs) == round(rs[0]["target"])
        assert rs[0]["target"] <= 3 * rs[0]["source_size"]
        assert rs[0]["source_size"] == sum(r["size"] for r in rs)
    total = sum(r["size"] for r in rows)
    assert sum(rs[0]["target"] for rs in by_source.values()) == pytest.approx(total)
    assert sorted(map(tuple, mixing.mix_sources(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_targets_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 20)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # Shares of 1030 by 1, 2, 3; a and null stop at 30 and 60, b takes the rest.
    assert got == pytest.approx({"a": 30.0, None: 60.0, "b": 940.0})


def test_mixed_documents_are_whole(spark):
    docs = table(spark)
    copies = sum(r["copies"] for r in mixing.mix_sources(docs).collect())
    mixed = mixing.mix_documents(docs)
    assert mixed.count() == copies and mixed.columns == docs.columns


def test_kept_hash_of_empty(spark):
    got = line_dedup.dedup_lines(table(spark)).where("doc_id = 3").select(F.sha2("kept_text", 256)).collect()[0][0]
    assert got == hashlib.sha256(b"").hexdigest()
