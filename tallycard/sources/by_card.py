"""Tables that are stored by card: transactions and accounts meet without an exchange of either.

Both are bucketed by `card_id` into the same number of buckets, in the session's warehouse folder. The join with the
accounts and the ledger's window then take a bucket each as it lies, run after run, where plain tables are shuffled each time.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallycard.operators import heavy
from tallycard.operators.rules import accounts

KEY = "card_id"


@dataclass
class ByCard:
    """Transactions and `rules.accounts`, stored by card."""

    transactions: DataFrame
    accounts: DataFrame


def _dealt(rows, buckets, heavy_rows):
    """Light cards by bucket, so that a bucket has one file; rows of heavy cards stay where they are, over many tasks."""
    found = heavy.find(rows, heavy_rows)
    if found is None:
        return rows.repartition(buckets, KEY)
    return found.without(rows).repartition(buckets, KEY).unionByName(found.only(rows))


def _stored(rows, name, buckets):
    rows.write.bucketBy(buckets, KEY).sortBy(KEY).mode("errorifexists").saveAsTable(name)
    return rows.sparkSession.table(name)


def store_by_card(transactions, cards, customers, name, buckets=200, heavy_rows=heavy.HEAVY_ROWS):
    """Store the transactions and the accounts as tables `{name}_transactions` and `{name}_accounts`."""
    held = accounts(cards, customers).repartition(buckets, KEY)
    return ByCard(
        _stored(_dealt(transactions, buckets, heavy_rows), f"{name}_transactions", buckets),
        _stored(held, f"{name}_accounts", buckets),
    )
