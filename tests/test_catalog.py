"""Every registered query of the core against its SQL."""

import pytest
from compare import by_sql, in_order

from quirebase.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    result = QUERIES[name](spark, small)
    rows = [tuple(r) for r in result.collect()]
    if name in SQL:
        columns, expected = by_sql(small, SQL[name])
        assert sorted(columns) == sorted(result.columns)
        assert in_order(result.columns, rows) == in_order(columns, expected)
    else:
        assert rows


def test_entry_counts_chunks_by_language(spark, small):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert sum(r.chunks for r in rows) >= sum(r.documents for r in rows) > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
