"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests import compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.duck(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert compare.difference(got, compare.sql_rows(duck, SQL[name])) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
