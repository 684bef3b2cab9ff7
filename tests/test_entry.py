import __spark_entry__
from helixframe.plans import catalogue


def test_contract(spark):
    known, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(known) and set(catalogue.QUERIES) <= set(known)
    assert all(callable(f) for f in known.values())


def test_entry_runs(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[:3] == ["sample", "chr", "cn_pred"] and df.count() > 0
