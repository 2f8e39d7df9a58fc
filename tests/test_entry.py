import importlib

from conftest import SF


def test_entry_and_contract(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["doc_id", "chunk_index", "start", "end", "chunk"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # every query outside the optional subpackage has an oracle
    from fileflow.plans import catalogue
    assert set(catalogue.QUERIES) <= set(o)


def test_every_query_builds_on_smoke_data(spark):
    E = importlib.import_module("__spark_entry__")
    from fileflow.plans import catalogue
    for name in catalogue.QUERIES:
        fn = E.queries()[name]
        df = fn(spark, SF)
        df.limit(1).collect()
        assert len(df.columns) == len(set(df.columns)), name
