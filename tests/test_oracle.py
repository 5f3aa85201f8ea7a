"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as entry
from gridledger.plans import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(registry.REGISTRY))
def test_query_equals_sql(spark, connection, key):
    sql = oracle.all_sql()
    assert key in sql
    assert compare(spark, connection, SF_DIR, key, registry.REGISTRY[key], sql[key]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
