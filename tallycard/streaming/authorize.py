"""Authorisation of a stream, in two forms with the same rows.

`authorize_stream` is a stateful operator for small, frequent micro-batches. Cards are dealt into buckets; the state of a
bucket is the pending balance of each of its cards, in cents, kept in RocksDB and restored from the checkpoint together
with the source position. All new rows of a bucket are put in order and folded at once, as arrays. They
meet in one task, so micro-batches must be bounded; a card may have any number of rows over many of them.

`authorize_batches` is for large micro-batches, as when a history is replayed: each one is a run of the
batch operator, which splits cards with many rows over tasks.
"""

import threading
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.listener import StreamingQueryListener

from tallycard.operators.authorize import REASON_FROM, authorize, outcome
from tallycard.operators.heavy import HEAVY_ROWS
from tallycard.operators.ledger import ORDER, settle
from tallycard.operators.rules import BOOKED, VOID, accounts, precheck
from tallycard.operators.settle import card_totals, settle_balances
from tallycard.sources.files import CSV_DIALECT

# Micro-batches after which the balances of all cards touched so far are written once more.
COMPACT_EVERY = 16
# Parts that the cards are dealt into; at least as many as tasks run at a time. Belongs to the checkpoint of a query.
BUCKETS = 256
# Rows that go back to Spark at a time.
CHUNK_ROWS = 50_000
# Seconds to wait for the last report of a query that has ended.
LAST_REPORT = 60

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state."
    "RocksDBStateStoreProvider",
}
# What the fold reads: numbers without NULL, so that they stay 64-bit integers in pandas.
_FACTS = ("card", "moment", "number", "kind", "cents", "limit", "opening")
_FOLDED = "packed string, approved boolean, balance_cents long"
_LEAST = -(2**63)


class Balances:
    """The known balances of a bucket: card numbers in rising order, and the cents of each."""

    def __init__(self, cards=b"", cents=b""):
        self.cards, self.cents = (np.frombuffer(raw, dtype=np.int64) for raw in (cards, cents))

    def of(self, cards, otherwise):
        """The balances of these cards, or `otherwise` where none is known."""
        if not len(self.cards):
            return otherwise
        places = np.minimum(np.searchsorted(self.cards, cards), len(self.cards) - 1)
        return np.where(self.cards[places] == cards, self.cents[places], otherwise)

    def updated(self, cards, cents):
        """The state with these balances, as two byte strings."""
        stay = ~np.isin(self.cards, cards)
        all_cards = np.concatenate((self.cards[stay], cards))
        order = np.argsort(all_cards)
        return all_cards[order].tobytes(), np.concatenate((self.cents[stay], cents))[order].tobytes()


def fold(known, card, moment, number, kind, cents, limit, opening):
    """Decide the new rows of a bucket, each card's in order, from the known balances.

    Returns (order, approved, balance, touched cards, their balances). `order` are the places of the rows that have a
    balance; the others are declined.
    """
    live = np.flatnonzero(kind != VOID)
    order = live[np.lexsort((number[live], moment[live], card[live]))]
    card, kind, cents, limit, opening = (column[order] for column in (card, kind, cents, limit, opening))
    starts = np.diff(card, prepend=0) != 0
    starts[:1] = True
    firsts = np.flatnonzero(starts)
    moves = np.where(kind >= BOOKED, cents, 0)
    total = np.cumsum(moves)
    opened = known.of(card[firsts], opening[firsts]) - (total[firsts] - moves[firsts])
    sizes = np.diff(np.append(firsts, len(card)))
    approved, balance, _ = settle(starts, kind, cents, total + np.repeat(opened, sizes), limit, 0)
    # Until a row is booked, the card's own balance counts.
    booked = np.logical_or.reduceat(approved | (kind == BOOKED), firsts) if len(firsts) else firsts.astype(bool)
    lasts = firsts + sizes - 1
    return order, approved, balance, card[firsts][booked], balance[lasts][booked]


class PendingBalances(StatefulProcessor):
    """Folds the new rows of a bucket of cards from the balances the cards had before this micro-batch."""

    def init(self, handle):
        binary = [T.StructField(name, T.BinaryType()) for name in ("cards", "cents")]
        self.state = handle.getValueState("pending", T.StructType(binary))

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(rows, ignore_index=True)
        known = self.state.get()
        known = Balances(*map(bytes, known)) if known else Balances()
        facts = [new[name].to_numpy(dtype=np.int64) for name in _FACTS]
        order, approved, balance, cards, cents = fold(known, *facts)
        if len(cards):
            self.state.update(known.updated(cards, cents))
        void = np.flatnonzero(new["kind"].to_numpy() == VOID)
        packed = new["packed"].to_numpy()[np.concatenate((order, void))]
        approved = np.concatenate((approved, np.zeros(len(void), dtype=bool)))
        balance = np.concatenate((balance, np.zeros(len(void), dtype=np.int64)))
        for start in range(0, len(packed), CHUNK_ROWS):
            part = slice(start, start + CHUNK_ROWS)
            yield pd.DataFrame({"packed": packed[part], "approved": approved[part], "balance_cents": balance[part]})

    def close(self):
        pass


def _moment(kind):
    """The timestamp in microseconds; what is missing comes first, as in a Spark sort."""
    time = F.col(ORDER[0])
    if isinstance(kind, T.TimestampType):
        return F.coalesce(F.unix_micros(time), F.lit(_LEAST))
    # Without a time zone, so no hour is skipped or comes twice.
    minutes = (F.unix_date(F.to_date(time)).cast("long") * 24 + F.hour(time)) * 60 + F.minute(time)
    seconds = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")
    return F.coalesce(minutes * 60_000_000 + seconds, F.lit(_LEAST))


_CALENDAR = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _packed(schema):
    """All columns as one text, which is one value for Python to carry."""
    texts = [
        F.col(field.name).cast("string").alias(field.name) if isinstance(field.dataType, _CALENDAR) else F.col(field.name)
        for field in schema.fields
    ]
    return F.to_json(F.struct(*texts))


def _unpacked(schema):
    """The columns back from the text."""
    texts = T.StructType(
        [
            T.StructField(field.name, T.StringType() if isinstance(field.dataType, _CALENDAR) else field.dataType)
            for field in schema.fields
        ]
    )
    row = F.from_json("packed", texts, {"mode": "FAILFAST"})
    return [row[field.name].cast(field.dataType).alias(field.name) for field in schema.fields]


def authorize_stream(transactions, cards, customers, reasons=False, buckets=BUCKETS):
    """Streaming twin of `operators.authorize.authorize`.

    Within a micro-batch a card's rows are taken in (timestamp, transaction_id) order; a row that comes
    in a later micro-batch follows those before it. The accounts are a plain table that is joined per
    micro-batch: broadcast if Spark finds it small, else shuffled, which a table bucketed by card saves.
    `reasons` adds `decline_reason`. `buckets` stays the same for all runs on one checkpoint. Card and transaction
    numbers are integers.
    """
    keep = [*transactions.columns, "kind"]
    if reasons:
        keep += [name for name in REASON_FROM if name not in keep]
    checked = precheck(transactions, accounts(cards, customers))
    kept = checked.select(*keep).schema
    number = F.col(ORDER[1]).cast("long")
    rows = checked.select(
        F.pmod(F.xxhash64("card_id"), F.lit(buckets)).alias("bucket"),
        F.coalesce(F.col("card_id").cast("long"), F.lit(0)).alias("card"),
        _moment(transactions.schema[ORDER[0]].dataType).alias("moment"),
        F.coalesce(number, F.lit(_LEAST)).alias("number"),
        F.col("kind").cast("long").alias("kind"),
        "cents",
        F.coalesce("limit_cents", F.lit(0)).alias("limit"),
        F.coalesce("opening_cents", F.lit(0)).alias("opening"),
        _packed(kept).alias("packed"),
    )
    folded = rows.groupBy("bucket").transformWithStateInPandas(
        PendingBalances(), T.StructType.fromDDL(_FOLDED), outputMode="append", timeMode="none"
    )
    return folded.select(*_unpacked(kept), "approved", "balance_cents").select(*outcome(transactions.columns, reasons))


class _Counter(StreamingQueryListener):
    """Adds up the rows that queries have read, report by report: one number for each run that is heard of."""

    def __init__(self):
        self.rows, self.ended, self.change = {}, set(), threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()

    def total(self, run):
        """Rows of a run that has ended; its reports come before the one of its end."""
        with self.change:
            if not self.change.wait_for(lambda: run in self.ended, LAST_REPORT):
                raise TimeoutError(f"no report of the end of run {run}")
        return self.rows.get(run, 0)


@contextmanager
def _streaming_settings(spark):
    """What queries started inside the block need: RocksDB state."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _run(spark, writer, checkpoint):
    """Process what the source holds, then stop. Returns the number of records read, over any number of micro-batches."""
    writer, counter = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True), _Counter()
    spark.streams.addListener(counter)
    try:
        with _streaming_settings(spark):
            query = writer.start()
        query.awaitTermination()
        return counter.total(str(query.runId))
    finally:
        spark.streams.removeListener(counter)


def drain(stream, sink, checkpoint, form="parquet"):
    """Append what the source holds to a folder of parquet (or CSV) files and stop.

    Returns the number of records read. Run again on the same checkpoint, it goes on where it stopped.
    """
    writer = stream.writeStream.format(form).outputMode("append").option("path", sink)
    if form == "csv":
        writer = writer.options(**CSV_DIALECT)
    return _run(stream.sparkSession, writer, checkpoint)


def authorize_batches(
    transactions, cards, customers, sink, checkpoint, heavy_rows=HEAVY_ROWS, reasons=False
):
    """Authorise what the source holds, one run of `authorize` per micro-batch.

    The result of micro-batch n is `sink/batch=n`. The balances it leaves on the cards it touched are a table next
    to the checkpoint, every COMPACT_EVERY micro-batches those of all cards touched so far; the following
    micro-batch opens with the last balance of each card. A micro-batch that is repeated after a
    failure replaces its own tables only, so each transaction counts once. `reasons` adds `decline_reason`.

    Returns the number of transactions processed.
    """
    spark, processed = transactions.sparkSession, 0

    def balances(number):
        """The balances after micro-batch `number`, of all cards touched by then."""
        since = range(number - number % COMPACT_EVERY, number + 1)
        tables = [
            spark.read.parquet(f"{checkpoint}-balances/{n}").withColumn("number", F.lit(n)) for n in since
        ]
        last = F.max_by("pending_balance", "number").alias("pending_balance")
        return reduce(DataFrame.unionByName, tables).groupBy("card_id").agg(last)

    def authorise(batch, number):
        nonlocal processed
        opened = settle_balances(cards, balances(number - 1)) if number else cards
        out = f"{sink}/batch={number}"
        judged = authorize(batch, opened, customers, heavy_rows=heavy_rows, reasons=reasons)
        judged.write.mode("overwrite").parquet(out)
        touched = card_totals(spark.read.parquet(out)).select("card_id", "pending_balance")
        touched = touched.where(F.col("pending_balance").isNotNull())
        if number and number % COMPACT_EVERY == 0:
            others = balances(number - 1).join(touched, "card_id", "left_anti")
            touched = touched.unionByName(others)
        touched.write.mode("overwrite").parquet(f"{checkpoint}-balances/{number}")
        # Counted in the files' footers, once the micro-batch is done.
        processed += spark.read.parquet(out).count()

    _run(spark, transactions.writeStream.foreachBatch(authorise), checkpoint)
    return processed


def authorised_batches(spark, sink):
    """The results of `authorize_batches`."""
    return spark.read.parquet(sink).drop("batch")
