"""Queries with SQL against it; all others run on the smallest tables."""

import pytest
from compare import by_sql, in_order

catalog = pytest.importorskip("quirebase.llm.catalog")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, small, name):
    result = catalog.queries()[name](spark, small)
    rows = [tuple(r) for r in result.collect()]
    if name in catalog.oracle_sql():
        columns, expected = by_sql(small, catalog.oracle_sql()[name])
        assert sorted(columns) == sorted(result.columns)
        assert in_order(result.columns, rows) == in_order(columns, expected)
    assert rows
