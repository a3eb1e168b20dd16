"""The registered queries that SQL can express, against it in an independent engine."""

import pytest

from oracle_compare import compare, database
from tallycard.llm import oracle

from conftest import DATA


@pytest.fixture(scope="module")
def con():
    return database(DATA)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, DATA, name) is None
