"""The driver contract: every SQL text belongs to a query, and the flagship runs."""

import __spark_entry__ as entry


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 70
    rows = entry.entry(spark)
    assert rows.columns == ["mes", "n_name", "lineas", "centavos"] and rows.count() > 0
