"""The batch job over authorised transactions."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallycard.operators import settle
from tallycard.operators.heavy import HEAVY_ROWS
from tallycard.operators.authorize import authorize
from tallycard.operators.ledger import LAST


@dataclass
class Settlement:
    """Results of one batch run."""

    batch_transactions: DataFrame
    discrepancies: DataFrame
    cards_updated: DataFrame
    customers_updated: DataFrame


def settle_day(authorised, cards, customers, stage=None):
    """Approve, reconcile, settle, re-score and re-limit, in this order.

    Where `batch_transactions` is not wanted, `authorised` needs the columns `settle.TOTALS_FROM` only. It either has the
    mark of the last row of each card (`mark_last`) or the columns of their order.

    `stage(df, name)` may write a table and return it read back. It is called on the small tables that
    several results share, so that a job which stores all results aggregates the transactions once.
    """
    stage = stage or (lambda df, name: df)
    approved = settle.approve_pending(authorised)
    totals = stage(settle.card_totals(approved), "card_totals")
    settled = stage(settle.settle_balances(cards, totals), "settled_cards")
    scored = stage(settle.adjust_scores(customers, settled), "scored_customers")
    return Settlement(
        batch_transactions=approved.drop(LAST),
        discrepancies=settle.reconcile(totals, cards),
        cards_updated=settle.final_cards(settle.revise_limits(settled, scored)),
        customers_updated=settle.final_customers(scored),
    )


def process(transactions, cards, customers, heavy_rows=HEAVY_ROWS, stage=None):
    """Authorise raw transactions, then settle them."""
    authorised = authorize(transactions, cards, customers, heavy_rows=heavy_rows, mark_last=True)
    if stage:
        authorised = stage(authorised, "authorised")
    return settle_day(authorised, cards, customers, stage)
