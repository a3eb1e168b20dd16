"""Stateless part of the authorisation: look up the account, judge the transaction by itself."""

from pyspark.sql import functions as F

from tallycard.functions.money import cents, has_part_of_cent
from tallycard.functions.places import zip_code, zips_close

# The types which move a balance whatever the rules say. Case matters.
ALWAYS_BOOKED = ("refund", "cancellation")

# What a transaction may do to its card's pending balance.
VOID = -1  # no such card or customer, or its limit or opening balance is unknown: there is no balance
BLOCKED = 0  # declined by a stateless rule: leaves the balance alone
BOOKED = 1  # refund or cancellation: always moves the balance
GUARDED = 2  # moves the balance if the result stays within the limit

# The rules that leave a transaction without a balance.
NO_BALANCE = ("card", "customer", "limit", "balance")


def accounts(cards, customers):
    """One row per card: what the rules need to know about the card and its holder."""
    holders = customers.select(
        "customer_id",
        zip_code(F.col("address")).alias("home_zip"),
        F.col("address").alias("home_address"),
        F.lit(True).alias("has_holder"),
    )
    return cards.select(
        "card_id", "customer_id", "credit_limit", "current_balance", F.lit(True).alias("has_card")
    ).join(holders, "customer_id", "left")


def always_booked():
    return F.coalesce(F.col("transaction_type").isin(*ALWAYS_BOOKED), F.lit(False))


def under_review():
    """Refunds, cancellations and credits skip the half-limit and the distance rule."""
    return F.coalesce(F.col("amount") >= 0, F.lit(False)) & ~always_booked()


def breaks_half_limit():
    """A single amount of half the credit limit or more."""
    return under_review() & (cents(F.col("amount")) * 2 >= cents(F.col("credit_limit")))


def is_close():
    return zips_close(F.col("merchant_zip"), F.coalesce("home_zip", F.lit("")))


def breaks_distance():
    """A merchant whose region is not the home region, or is not known."""
    return under_review() & ~is_close()


def with_accounts(transactions, accounts):
    """Transactions next to their account.

    The merchant's ZIP is read before the join, so that the shuffle need not carry the location where
    nothing else asks for it.
    """
    located = transactions.withColumn("merchant_zip", zip_code(F.col("location")))
    return located.join(accounts, "card_id", "left")


def precheck(transactions, accounts):
    """Transactions with their account, the cents to book and the `kind` of booking.

    `rule` names the stateless rule that declined a row. The distance rule counts only where the
    half-limit rule passed. An amount that is finer than a cent is declined, whatever its type: cents are all a balance
    holds, and no amount becomes another one.
    """
    rule = (
        F.when(F.col("has_card").isNull(), "card")
        .when(F.col("has_holder").isNull(), "customer")
        .when(cents(F.col("credit_limit")).isNull(), "limit")
        .when(cents(F.col("current_balance")).isNull(), "balance")
        .when(cents(F.col("amount")).isNull(), "amount")
        .when(has_part_of_cent(F.col("amount")), "fraction")
        .when(breaks_half_limit(), "half")
        .when(breaks_distance(), "distance")
    )
    kind = (
        F.when(F.col("rule").isin(*NO_BALANCE), F.lit(VOID))
        .when(F.col("rule").isNotNull(), F.lit(BLOCKED))
        .when(always_booked(), F.lit(BOOKED))
        .otherwise(F.lit(GUARDED))
    )
    judged = with_accounts(transactions, accounts).withColumn("rule", rule)
    return judged.withColumns(
        {
            "kind": kind,
            "cents": F.coalesce(cents(F.col("amount")), F.lit(0).cast("bigint")),
            "limit_cents": cents(F.col("credit_limit")),
            "opening_cents": cents(F.col("current_balance")),
        }
    )
