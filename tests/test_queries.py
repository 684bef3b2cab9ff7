"""Every registered query with SQL against DuckDB at the smallest scale."""

import math
import os

import duckdb
import pytest

from helixframe.plans import catalogue

DATA = "/root/testdata/sf0.001"
SQL = catalogue.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        path = f"{DATA}/{name}"
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    clean = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 4) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got, want = plain(df.collect(), df.columns), plain(cursor.fetchall(), columns)
    assert len(got) == len(want) and all(a == pytest.approx(b, abs=2e-4) if all(isinstance(x, float) for x in a) else near(a, b) for a, b in zip(got, want))


def near(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) < 2e-4) for x, y in zip(a, b))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def prices_near_no_change(spark, tmp_path):
    """Orders whose log2 is rounded to 0 from below and above, and one of exactly 0."""
    orders = [(i, "F", p) for i, p in enumerate((249_999.9, 250_000.0, 250_000.1, 249_999.8, 1234.5))]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    return con


def test_vcf_records_keep_the_sign_of_zero(spark, tmp_path):
    want = sorted(prices_near_no_change(spark, tmp_path).execute(SQL["vcf_records"]).fetchall())
    assert sorted(map(tuple, catalogue.QUERIES["vcf_records"](spark, str(tmp_path)).collect())) == want
    assert sum("LOG_ODDS_RATIO=-0.000000;" in r[0] for r in want) == 1


def test_vcf_records_of_depths_keep_the_sign_of_zero(spark, tmp_path):
    want = sorted(prices_near_no_change(spark, tmp_path).execute(SQL["vcf_records_of_depths"]).fetchall())
    assert sorted(map(tuple, catalogue.QUERIES["vcf_records_of_depths"](spark, str(tmp_path)).collect())) == want


def test_strand_bias_of_odd_quantities(spark, tmp_path):
    """Quantities that are no whole numbers, or missing."""
    rows = [(i, q, i * 7, i * 3, 1 + i % 7) for i, q in enumerate((2.5, 3.5, 7.7, 9.2, 4.0, None, 12.6, 30.0))]
    spark.createDataFrame(rows, "l_orderkey long, l_quantity double, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    cursor = con.execute(SQL["fisher_strand_bias"])
    columns = [c[0] for c in cursor.description]
    df = catalogue.QUERIES["fisher_strand_bias"](spark, str(tmp_path))
    assert plain(df.collect(), df.columns) == plain(cursor.fetchall(), columns)
