"""Driver contract: registry shape and the smoke entry."""

import __spark_entry__ as E


def test_registry_shape():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 100
    assert set(s) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(v, str) and "SELECT" in v.upper() for v in s.values())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert {"customer_id", "future_disengaged", "future_growth", "tx_median"} <= set(df.columns)
