"""Driver contract: entry runs, every query has a callable, oracle keys are a subset."""

import __spark_entry__ as E


def test_contract_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 50
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "predicted_probability" in df.columns
