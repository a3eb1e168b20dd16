"""Tables stored by card."""

import uuid

import pytest

from tallycard import fixtures
from tallycard.operators.authorize import authorize
from tallycard.sources.by_card import store_by_card

from conftest import DATA


@pytest.mark.parametrize("heavy_rows", [None, 8])
def test_neither_side_is_shuffled(spark, rows, heavy_rows):
    tables = fixtures.Bank(spark, DATA)
    given = [tables[name] for name in ("transactions", "cards", "customers")]
    stored = store_by_card(*given, f"t_{uuid.uuid4().hex}", buckets=6, heavy_rows=heavy_rows or 10**9)
    assert rows(stored.transactions) == rows(given[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = authorize(stored.transactions, None, None, held=stored.accounts, heavy_rows=None)
        found = rows(judged)
        plan = judged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SelectedBucketsCount: 6 out of 6" in plan
    assert found == rows(authorize(*given))
    split = authorize(stored.transactions, None, None, held=stored.accounts, heavy_rows=10)
    assert rows(split) == found
