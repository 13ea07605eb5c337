"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import difference, sql_connection
from checks.queries import QUERIES
from checks.sql import SQL

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SF_DIR)


def test_entry(spark):
    assert [r["risk_level"] for r in entry.entry(spark).collect()] == ["HIGH", "MEDIUM", "LOW"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    result = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(result, connection.sql(SQL[name]).df()) is None
