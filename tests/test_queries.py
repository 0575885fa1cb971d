"""Every registered query against its SQL in another engine."""

import compare
import pytest

import __spark_entry__ as entry
from profilegate.plans import oracle
from profilegate.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.statements()


@pytest.fixture(scope="module")
def other():
    return compare.connect(FOLDER)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, other, name):
    (columns, rows), (sql_columns, sql_rows) = compare.both(spark, other, entry.queries()[name], SQL[name], FOLDER)
    assert columns == sql_columns
    assert rows == sql_rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
