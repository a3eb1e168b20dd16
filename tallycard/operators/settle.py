"""Batch side: approve, reconcile, settle, re-score, revise limits.

Pure functions of DataFrames. Nothing is collected; each is one aggregation or one equi-join on a key.
"""

from pyspark.sql import functions as F

from tallycard import schemas
from tallycard.functions.bands import revised_limit, score_change, utilisation
from tallycard.functions.money import cents, exact, from_cents
from tallycard.operators.ledger import LAST, ORDER


# Columns of the transactions which the per-card totals need next to status, pending balance and the mark of the last row.
TOTALS_FROM = ("card_id", "amount")


def approve_pending(transactions):
    """pending -> approved; every other status, NULL included, stays."""
    status = F.col("status")
    approved = F.when(status == "pending", "approved").otherwise(status)
    return transactions.withColumn("status", approved)


def _last_pending(transactions):
    """Pending balance after the last row in (timestamp, transaction_id) order.

    Where the ledger has marked that row, totals are hashed; else they are sorted by card.
    """
    if LAST in transactions.columns:
        return F.max(F.when(F.col(LAST), F.col("pending_balance")))
    return F.max_by("pending_balance", F.struct(*ORDER))


def _approved_cents():
    return F.sum(F.when(F.col("status") == "approved", cents(F.col("amount"))))


def last_pending_balance(transactions):
    """Pending balance of each card after its last transaction."""
    return transactions.groupBy("card_id").agg(_last_pending(transactions).alias("pending_balance"))


def approved_sum(transactions):
    """Sum of approved amounts per card which has any."""
    approved = transactions.where(F.col("status") == "approved")
    return approved.groupBy("card_id").agg(
        from_cents(F.sum(cents(F.col("amount")))).alias("recalculated_pending")
    )


def card_totals(transactions):
    """Last pending balance and approved sum per card from one pass and one shuffle.

    Both are reduced on the map side, so the shuffle carries at most one row per card and task and a
    card with most of the rows is no heavier than others.
    """
    return transactions.groupBy("card_id").agg(
        _last_pending(transactions).alias("pending_balance"),
        from_cents(_approved_cents()).alias("recalculated_pending"),
    )


def reconcile(totals, cards):
    """Cards whose last pending balance is not the opening balance plus the approved sum.

    A declined refund is booked all the same but not approved, so it shows up here by design. A card
    without a known balance shows up, with no discrepancy, if amounts were approved on it all the same.
    """
    pending, opening = cents(F.col("pending_balance")), cents(F.col("current_balance"))
    expected = pending - opening
    # No approved amounts add up to nothing.
    found = expected - F.coalesce(cents(F.col("recalculated_pending")), F.lit(0))
    unknown = expected.isNull() & F.col("recalculated_pending").isNotNull()
    return (
        totals.join(cards.select("card_id", "current_balance"), "card_id", "left")
        .where((found != 0) | unknown)
        .select(
            "card_id",
            "pending_balance",
            "current_balance",
            from_cents(expected).alias("expected_sum"),
            "recalculated_pending",
            from_cents(found).alias("discrepancy"),
        )
    )


def settle_balances(cards, totals):
    """Each card's last pending balance becomes its current balance."""
    settled = F.coalesce("pending_balance", "current_balance")
    return (
        cards.join(totals.select("card_id", "pending_balance"), "card_id", "left")
        .withColumn("current_balance", settled)
        .select(*cards.columns)
    )


def credit_utilisation(cards):
    """Balance, limit and their ratio in percent over all cards of a customer."""
    return (
        cards.groupBy("customer_id")
        .agg(
            F.sum(exact(F.col("current_balance"))).alias("total_balance"),
            F.sum(exact(F.col("credit_limit"))).alias("total_limit"),
        )
        .select(
            "customer_id",
            F.col("total_balance").cast("double").alias("total_balance"),
            F.col("total_limit").cast("double").alias("total_limit"),
            utilisation(F.col("total_balance"), F.col("total_limit")).alias("usage_percentage"),
        )
    )


def adjust_scores(customers, cards):
    """Customers with the new score and its change. Without cards, both are NULL."""
    change = credit_utilisation(cards).select(
        "customer_id", score_change(F.col("usage_percentage")).alias("credit_score_change")
    )
    return customers.join(change, "customer_id", "left").withColumn(
        "credit_score", F.col("credit_score") + F.col("credit_score_change")
    )


def revise_limits(cards, scored):
    """Limits of all cards of a customer follow the change of the customer's score."""
    change = F.coalesce("credit_score_change", F.lit(0))
    return (
        cards.join(scored.select("customer_id", "credit_score_change"), "customer_id", "left")
        .withColumn("credit_limit", revised_limit(F.col("credit_limit"), change))
        .select(*cards.columns)
    )


def final_cards(cards):
    return cards.select(*schemas.CARDS.names).orderBy("card_id")


def final_customers(customers):
    return customers.select(*schemas.CUSTOMERS.names).orderBy("customer_id")
