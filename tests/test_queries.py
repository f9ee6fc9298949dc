"""Every registered query against its SQL on the given tables."""

import compare
import pytest

import __spark_entry__ as entry
from tallywatch.catalog.oracle import ORACLE as SQL
from tallywatch.catalog.queries import QUERIES



@pytest.fixture(scope="module")
def con(tiny):
    return compare.duck(tiny)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tiny, con, name):
    assert compare.differences(QUERIES[name](spark, tiny), con, SQL[name]) is None


def test_entry_has_the_45_columns(spark):
    assert len(entry.entry(spark).columns) == 45
