"""Every registered query against its SQL in an independent engine."""

import os

import pytest

import __spark_entry__ as spark_entry
from conftest import DATA
from tallycard import catalog, oracle
from oracle_compare import compare, database

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return database(DATA)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, DATA, name) is None


def test_each_query_has_its_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
