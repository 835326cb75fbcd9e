"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from corpusframe.checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
