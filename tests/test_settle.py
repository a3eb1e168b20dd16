import pytest
from pyspark.sql import functions as F

import bank
from tallycard import fixtures, schemas
from tallycard.operators import settle
from tallycard.operators.authorize import authorize
from tallycard.plans import batch

from conftest import DATA


def authorised(spark, *rows):
    """(id, card_id, amount, status, pending_balance[, minute])"""
    plain = bank.transactions(
        spark, *[(r[0], r[1], r[2], "purchase", bank.NEAR, r[5] if len(r) > 5 else None) for r in rows]
    )
    judged = spark.createDataFrame(
        [(r[0], r[3], r[4]) for r in rows], "transaction_id int, status string, pending_balance double"
    )
    return plain.join(judged, "transaction_id").select(*schemas.AUTHORISED.names)


def test_approve_pending_leaves_other_statuses(spark, rows):
    made = authorised(
        spark, (1, 1, 1.0, "pending", 1.0), (2, 1, 1.0, "declined", 1.0), (3, 1, 1.0, None, 1.0),
        (4, 1, 1.0, "approved", 1.0),
    )
    assert rows(settle.approve_pending(made), "transaction_id", "status") == [
        (1, "approved"), (2, "declined"), (3, None), (4, "approved"),
    ]


def test_last_pending_is_by_time_then_number(spark, rows):
    made = authorised(
        spark, (5, 1, 1.0, "pending", 5.0, 1), (4, 1, 1.0, "pending", 4.0, 7),
        (3, 1, 1.0, "pending", 3.0, 7), (9, 2, 1.0, "pending", 9.0, 2),
    )
    assert rows(settle.last_pending_balance(made)) == [(1, 4.0), (2, 9.0)]


def test_totals_equal_the_separate_aggregates(spark, rows):
    made = authorised(
        spark, (1, 1, 0.1, "approved", 0.1), (2, 1, 0.2, "approved", 0.3), (3, 1, 9.0, "declined", 0.3),
        (4, 2, 9.0, "declined", 7.0),
    )
    assert rows(settle.card_totals(made)) == [(1, 0.3, 0.3), (2, 7.0, None)]
    assert rows(settle.approved_sum(made)) == [(1, 0.3)]


def test_reconcile_reports_what_does_not_add_up(spark, rows):
    made = authorised(
        spark, (1, 1, 30.0, "approved", 130.0),  # fine
        (2, 2, -5.0, "declined", 95.0),  # a declined refund was booked
        (3, 99, 5.0, "declined", None),  # no such card
        (4, 3, 5.0, "approved", 100.0),  # approved and not booked
    )
    cards = bank.cards(spark, (1, 1, 1.0, 100.0), (2, 1, 1.0, 100.0), (3, 1, 1.0, 100.0), (4, 1, 1.0, 1.0))
    report = settle.reconcile(settle.card_totals(made), cards)
    assert report.columns == [
        "card_id", "pending_balance", "current_balance", "expected_sum", "recalculated_pending",
        "discrepancy",
    ]
    assert rows(report) == [(2, 95.0, 100.0, -5.0, None, -5.0), (3, 100.0, 100.0, 0.0, 5.0, -5.0)]


def test_settling_keeps_cards_without_transactions(spark, rows):
    made = authorised(spark, (1, 1, 30.0, "approved", 130.0), (2, 99, 1.0, "declined", None))
    cards = bank.cards(spark, (1, 1, 1.0, 100.0), (2, 1, 1.0, 7.5))
    settled = settle.settle_balances(cards, settle.card_totals(made))
    assert rows(settled, "card_id", "current_balance") == [(1, 130.0), (2, 7.5)]
    assert settled.columns == schemas.CARDS.names


def test_scores_and_limits_follow_the_customer(spark, rows):
    cards = bank.cards(
        spark, (1, 10, 1000.0, 900.0), (2, 10, 2500.0, 0.0),  # 25.7 %: +5
        (3, 20, 8500.0, 5100.0),  # 60 %: -15
        (4, 30, 0.0, 5.0),  # no limit: unknown
        (5, 77, 1250.0, 1250.0),  # no such customer
        (6, 40, 3000.0, -10.0),  # in credit: +15
    )
    customers = bank.customers(
        spark, (10, "", 700), (20, "", 584), (30, "", 600), (40, "", 849), (50, "", 650)
    )
    scored = settle.adjust_scores(customers, cards)
    assert rows(scored, "customer_id", "credit_score", "credit_score_change") == [
        (10, 705, 5), (20, 569, -15), (30, None, None), (40, 864, 15), (50, None, None),
    ]
    assert rows(settle.revise_limits(cards, scored), "card_id", "credit_limit") == [
        (1, 1000.0), (2, 2500.0), (3, 7600.0), (4, 0.0), (5, 1250.0), (6, 3000.0),
    ]


def test_batch_uses_settled_balances_and_old_limits(spark, rows):
    cards = bank.cards(spark, (1, 10, 1000.0, 0.0), (2, 10, 1000.0, 0.0))
    customers = bank.customers(spark, (10, bank.HOME, 700))
    transactions = bank.transactions(spark, (1, 1, 450.0), (2, 1, 450.0), (3, 2, 600.0))
    result = batch.process(transactions, cards, customers)
    assert rows(result.batch_transactions, "transaction_id", "status") == [
        (1, "approved"), (2, "approved"), (3, "declined"),
    ]
    assert rows(result.customers_updated, "customer_id", "credit_score") == [(10, 695)]
    # 900 of 2000 is 45 %: -5 points, limits x 0.95, and 950 goes to the even hundred
    assert rows(result.cards_updated, "card_id", "credit_limit", "current_balance") == [
        (1, 1000.0, 900.0), (2, 1000.0, 0.0),
    ]
    assert result.discrepancies.count() == 0
    assert result.customers_updated.columns == schemas.CUSTOMERS.names


def test_results_are_sorted_by_key(spark):
    cards = bank.cards(spark, *[(n, n, 100.0, 0.0) for n in (5, 3, 9, 1)])
    customers = bank.customers(spark, *[(n, "") for n in (5, 3, 9, 1)])
    assert [row["card_id"] for row in settle.final_cards(cards).collect()] == [1, 3, 5, 9]
    assert [row["customer_id"] for row in settle.final_customers(customers).collect()] == [1, 3, 5, 9]


@pytest.mark.parametrize("name", ["card_totals", "settled_cards", "scored_customers"])
def test_shared_tables_can_be_stored_once(spark, name):
    seen = []

    def stage(df, label):
        seen.append(label)
        return df

    made = authorised(spark, (1, 1, 30.0, "pending", 130.0))
    batch.settle_day(made, bank.cards(spark, (1, 1, 1.0, 1.0)), bank.customers(spark, (1, "")), stage)
    assert name in seen


def test_totals_are_reduced_before_the_shuffle(spark):
    made = authorised(spark, (1, 1, 30.0, "pending", 130.0))
    plan = settle.card_totals(made)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning(card_id")


def test_totals_beyond_the_old_bound(spark, rows):
    cards = bank.cards(spark, (1, 10, 1e17, 1e17), (2, 10, 1000.0, 100.0))
    (customer, balance, limit, usage), = rows(settle.credit_utilisation(cards))
    assert (customer, balance, limit) == (10, 1e17 + 100, 1e17 + 1000)
    assert usage == pytest.approx(100.0)


def _plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_totals_of_marked_rows_are_hashed_without_a_sort(spark, rows):
    tables = fixtures.Bank(spark, DATA)
    given = [tables[name] for name in ("transactions", "cards", "customers")]
    plain = settle.card_totals(settle.approve_pending(authorize(*given)))
    marked = authorize(*given, columns=settle.TOTALS_FROM, mark_last=True)
    totals = settle.card_totals(settle.approve_pending(marked))
    assert rows(totals) == rows(plain)
    split = authorize(*given, columns=settle.TOTALS_FROM, mark_last=True, heavy_rows=6)
    assert rows(settle.card_totals(settle.approve_pending(split))) == rows(plain)
    last = settle.last_pending_balance(marked)
    assert rows(last) == rows(plain, "card_id", "pending_balance")
    plan = _plan(last)
    assert "SortAggregate" not in plan
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    # The only sorts belong to the join and the ledger's window, below the Python step.
    assert "Sort" not in final[: final.index("MapInArrow")]


def test_one_row_of_each_card_is_marked(spark):
    tables = fixtures.Bank(spark, DATA)
    given = [tables[name] for name in ("transactions", "cards", "customers")]
    for heavy_rows in (None, 5):
        marked = authorize(*given, mark_last=True, heavy_rows=heavy_rows).where("pending_balance IS NOT NULL")
        found = marked.groupBy("card_id").agg(
            F.count_if("last_of_card").alias("marked"),
            F.max_by("last_of_card", F.struct("timestamp", "transaction_id")).alias("right"),
        )
        assert found.where("marked <> 1 OR NOT right").count() == 0
        assert found.count() > 100
