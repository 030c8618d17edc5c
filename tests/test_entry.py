import __spark_entry__ as entry


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and all(map(callable, queries.values()))
