"""Calendar views of the transactions."""

import datetime

from pyspark.sql import functions as F

from tallycard.operators.ledger import ORDER

# The calendar day of a row, where the table is stored by day.
DAY = "day"


def with_day(transactions):
    """Transactions with the column that a table is stored by; NULL for those without a time."""
    return transactions.withColumn(DAY, F.to_date("timestamp"))


def _day_of(transactions):
    """The day of a row: of a table that is stored by day, no row has to be read for it."""
    return F.col(DAY) if DAY in transactions.columns else F.to_date("timestamp")


def _as_text(day):
    return F.date_format(day, "yyyy-MM-dd").alias("date")


def distinct_dates(transactions):
    """Days with transactions as yyyy-MM-dd text, oldest first."""
    days = transactions.select(_day_of(transactions).alias("day")).distinct()
    return days.orderBy("day").select(_as_text("day"))


def day_counts(transactions):
    """Transactions to replay per day, oldest day first."""
    days = transactions.groupBy(_day_of(transactions).alias("day"))
    counts = days.agg(F.count(F.lit(1)).alias("transactions"))
    return counts.orderBy("day").select(_as_text("day"), "transactions")


def transactions_between(transactions, first, last):
    """Transactions of the days `first` to `last`, both included.

    A range on the bare column, so the file reader and JDBC sources can skip by statistics or index; of a table that is
    stored by day, only the folders of these days are read. Without days, the transactions without a time.
    """
    if DAY in transactions.columns:
        days = F.col(DAY).isNull() if first is None else F.col(DAY).between(F.lit(first), F.lit(last))
        return transactions.where(days)
    if first is None:
        return transactions.where(F.col("timestamp").isNull())
    after = last + datetime.timedelta(days=1)
    ts = F.col("timestamp")
    return transactions.where(
        (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < F.lit(after).cast("timestamp_ntz"))
    )


def transactions_by_date(transactions, day):
    """One day's transactions in order."""
    return transactions_between(transactions, day, day).orderBy(*ORDER)


def transaction_count(transactions):
    return transactions.agg(F.count(F.lit(1)).alias("transaction_count"))
