import __spark_entry__ as e


def test_names():
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and "p2_found" in q


def test_flagship(spark):
    df = e.entry(spark)
    assert df.columns == ["id", "status", "n"] and df.count() > 0
