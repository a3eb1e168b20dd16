"""The whole job: replay, authorise as a stream, check completeness, settle, store."""

from tallycard import schemas
from tallycard.operators.checks import completeness, off_cent_amounts
from tallycard.operators.days import DAY
from tallycard.operators.heavy import HEAVY_ROWS
from tallycard.plans.batch import settle_day
from tallycard.sources.files import ingest_csv, write_table
from tallycard.sources.publish import publish
from tallycard.streaming.authorize import authorize_batches, authorised_batches
from tallycard.streaming.replay import day_ranges, landed, replay


class Incomplete(RuntimeError):
    """The stream did not deliver each transaction exactly once."""


class OffCent(RuntimeError):
    """Some amounts are finer than a cent, or no number of cents."""


def require_complete(expected, processed, key=schemas.PRIMARY_KEYS["transactions"]):
    """The gate before the batch job, transaction by transaction. Returns the two counts."""
    counts = completeness(expected, processed, key).first()
    if counts["result"] != "ok":
        raise Incomplete(
            f"{counts['result']}: {counts['processed']} of {counts['expected']} transactions,"
            f" {counts['lost']} lost, {counts['doubled']} doubled"
        )
    return counts["expected"], counts["processed"]


def require_whole_cents(transactions):
    """The gate before the replay: cents are all the ledger can keep."""
    odd = off_cent_amounts(transactions).select("transaction_id", "amount").take(3)
    if odd:
        raise OffCent(f"finer than a cent, among others: {[tuple(row) for row in odd]}")


def authorise_history(spark, bank, folder, slices=3, heavy_rows=HEAVY_ROWS):
    """Replay all transactions in `slices` ranges of days and authorise each as it has landed.

    A slice is one micro-batch, so it may have any size and any card may dominate it. Of transactions that are stored by
    day, each slice reads the folders of its own days, so each row is read once.
    """
    by_day = [DAY] if DAY in bank["transactions"].columns else []
    transactions = bank["transactions"].select(*schemas.TRANSACTIONS.names, *by_day)
    landing, sink = f"{folder}/landing", f"{folder}/stream_transactions"
    for days in day_ranges(transactions, slices):
        replay(transactions, landing, [days])
        authorize_batches(
            landed(spark, landing, schemas.TRANSACTIONS),
            bank["cards"],
            bank["customers"],
            sink,
            f"{folder}/checkpoint",
            heavy_rows,
        )
    return authorised_batches(spark, sink)


def whole(spark, csv, folder, slices=3, heavy_rows=HEAVY_ROWS, by_day=False):
    """From CSV files to published views, in a new `folder`.

    `csv` names the file or folder of each table in `schemas.TABLES`. All of them are ingested before anything is
    processed; a bad value in any stops the job there. `by_day` stores the transactions by day, which pays where a day has
    rows for files of its own: each slice then reads its own days only. Returns the published views by name; they are named
    after the results.
    """
    bank = {
        name: ingest_csv(spark, csv[name], schema, f"{folder}/ingested/{name}", by_day=by_day and name == "transactions")
        for name, schema in schemas.TABLES.items()
    }
    results = run(spark, bank, f"{folder}/run", slices, heavy_rows)
    return {name: publish(df, name) for name, df in results.items()}


def run(spark, bank, folder, slices=3, heavy_rows=HEAVY_ROWS):
    """Run all phases over the bank tables in a new `folder`; returns the stored results by name.

    Inputs are never overwritten: every phase writes its own table and the next one reads it back, so
    nothing is computed twice.
    """
    require_whole_cents(bank["transactions"])
    authorised = authorise_history(spark, bank, folder, slices, heavy_rows)
    require_complete(bank["transactions"], authorised)

    def stored(df, name):
        return write_table(df, f"{folder}/{name}")

    result = settle_day(authorised, bank["cards"], bank["customers"], stage=stored)
    return {name: stored(df, name) for name, df in vars(result).items()}
