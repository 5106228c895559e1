"""Every registered query against its SQL on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import compare, connect
from fleetgauge.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(ORACLE)
    assert set(ORACLE) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, name):
    assert compare(registry.queries()[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
