"""Every registered query of the core against its SQL, and those without SQL for a schema and rows."""

from __future__ import annotations

import pytest

from lectern import plans
from tests.conftest import SMALL, same

QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    same(QUERIES[name](spark, SMALL), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    found = QUERIES[name](spark, SMALL)
    assert found.columns and found.count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(plans.oracle_sql()) <= set(e.oracle_sql()) <= set(e.queries())
