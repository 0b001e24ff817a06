"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from checks import compare, oracle, queries

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle.oracle()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_sql_belongs_to_registered_queries():
    assert set(SQL) <= set(queries.QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, connection, name):
    result = compare.compare(spark, connection, SF_DIR, name, SQL.get(name))
    assert result.startswith(("ok", "rows-only")), result
    assert " 0 rows" not in result
