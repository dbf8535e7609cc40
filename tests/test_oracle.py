"""Every registered query against its SQL on the small tables."""

import __spark_entry__ as entry_points
import pytest
from compare import connect, differences

from trolley.oracle import oracle_sql
from trolley.plans.registry import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == ""


def test_entry_is_lazy_and_has_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns == [
        "department", "total_items_sold", "unique_products", "unique_orders", "reorder_rate_pct"
    ]
    assert result.count() == 6
