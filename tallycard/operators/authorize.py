"""Authorisation of transactions against the running pending balance of their card."""

from pyspark.sql import functions as F

from tallycard.functions.money import from_cents, money_text
from tallycard.operators import heavy
from tallycard.operators.ledger import LAST, run_ledger
from tallycard.operators.rules import VOID, accounts, always_booked, precheck


# Columns that the reasons are made of, of the transaction and of its account.
REASON_FROM = (
    "rule", "amount", "cents", "limit_cents", "customer_id", "home_address", "card_id", "location", "transaction_type"
)


def outcome(columns, reasons):
    """Final columns from `approved` and `balance_cents`."""
    out = [
        *columns,
        F.when(F.col("approved"), "pending").otherwise("declined").alias("status"),
        F.when(F.col("kind") != VOID, from_cents(F.col("balance_cents"))).alias("pending_balance"),
    ]
    return out + [decline_reason().alias("decline_reason")] if reasons else out


def decline_reason():
    """Why a row was declined; NULL if it was not. Going over the limit beats the other reasons.

    The wording is fixed, but for unknown limits and balances and for amounts finer than a cent.
    """
    total = F.col("balance_cents") + F.when(always_booked(), F.lit(0)).otherwise(F.col("cents"))
    limit = money_text(F.col("limit_cents"))

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    over = text("Total balance ", money_text(total), " exceeds credit limit ", limit)
    half = text(
        "Amount ", money_text(F.col("cents")), " exceeds 50% of credit limit ", limit
    )
    distance = text(
        "Merchant location ", shown("location"),
        " too far from customer address ", shown("home_address"),
    )
    return (
        F.when(F.col("approved"), F.lit(None).cast("string"))
        .when(F.col("rule") == "card", text("Card ID ", shown("card_id"), " not found"))
        .when(F.col("rule") == "customer", text("Customer ID ", shown("customer_id"), " not found"))
        .when(F.col("rule") == "limit", text("Credit limit of card ID ", shown("card_id"), " unknown"))
        .when(F.col("rule") == "balance", text("Balance of card ID ", shown("card_id"), " unknown"))
        .when(F.col("rule") == "amount", "Amount missing")
        .when(F.col("rule") == "fraction", text("Amount ", shown("amount"), " is finer than a cent"))
        .when(total > F.col("limit_cents"), over)
        .when(F.col("rule") == "half", half)
        .otherwise(distance)
    )


def authorize(
    transactions, cards, customers, reasons=False, heavy_rows=heavy.HEAVY_ROWS, columns=None, found=None, mark_last=False,
    held=None,
):
    """Adds `status` (pending / declined) and `pending_balance` after each row.

    Rows of a card are taken in the order of (timestamp, transaction_id). A row whose card or
    customer does not exist, or whose card has no known limit or balance, is declined with a NULL
    balance. `reasons` adds `decline_reason`.

    `columns` names the transaction columns to keep, by default all: fewer are cheaper, as Spark cannot
    see which ones the Python step passes on for nothing.

    Cards with more than `heavy_rows` rows are split over tasks; finding them runs a job over the `card_id`
    column when this is called. A job that authorises the same rows more than once passes what `heavy.find`
    gave it as `found`. Pass `heavy_rows=None` where no card can be that long.

    `held` are the accounts, as `rules.accounts` makes them, where they are stored; cards and customers are not read then.

    `mark_last` adds `last_of_card`, true for the last row of each card, from which `settle` makes totals without sorting.
    """
    held = accounts(cards, customers) if held is None else held
    columns = list(columns or transactions.columns)
    keep = columns + ["kind"]
    if reasons:
        keep += [name for name in REASON_FROM if name not in keep]

    last = F.lit(True) if mark_last else None

    def light(rows):
        return run_ledger(precheck(rows, held), keep, last=last)

    def finish(rows):
        return rows.select(*outcome(columns, reasons), *[LAST] * mark_last)

    if found is None and heavy_rows is not None:
        found = heavy.find(transactions, heavy_rows)
    if found is None:
        return finish(light(transactions))
    # The accounts of the heavy cards are as few as these cards, so the join moves none of their rows.
    split = precheck(found.only(transactions), found.small(found.only(held)))
    rest = light(found.without(transactions))
    return finish(rest.unionByName(heavy.run_heavy_ledger(split, keep, found, mark_last)))


def declined_report(transactions, cards, customers, **options):
    """The declined transactions with the reason as text."""
    shown = ["transaction_id", "card_id", "amount", "transaction_type"]
    judged = authorize(transactions, cards, customers, reasons=True, columns=shown, **options)
    return judged.where(F.col("status") == "declined").select(
        *shown, "decline_reason"
    )


def unknown_card_declines(transactions, cards):
    """Transactions on cards that do not exist."""
    known = cards.select("card_id")
    return transactions.join(known, "card_id", "left_anti").select(
        "transaction_id",
        "card_id",
        F.lit("declined").alias("status"),
        F.concat(
            F.lit("Card ID "), F.coalesce(F.col("card_id").cast("string"), F.lit("None")),
            F.lit(" not found"),
        ).alias("decline_reason"),
    )
