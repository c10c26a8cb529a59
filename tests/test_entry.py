import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["stock_id", "time_id", "target_var", "target_vol"]
    assert len(df.columns) == 259
    assert df.count() == 20
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60
