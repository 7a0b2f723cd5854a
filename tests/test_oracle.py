"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from orderflow.plans import registry
from tests.compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry.QUERIES, registry.ORACLE


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) is None
