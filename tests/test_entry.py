import importlib


def test_entry_smoke(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"Date", "borough", "Total_Hospitalization"} <= set(df.columns)


def test_every_query_has_a_callable_and_oracles_cover_most():
    entry = importlib.import_module("__spark_entry__")
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    from surge.plans.catalog import QUERIES  # the optional training-data queries have tests of their own
    assert len(set(o) & set(QUERIES)) >= 0.8 * len(QUERIES)
