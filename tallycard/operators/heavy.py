"""Cards with more rows than one task should walk: their ledgers are cut into segments of time.

A segment can be walked without its predecessors once its opening balance is known. The segments start
from the balances they would open with if nothing were declined, all in parallel. Each walk is exact
not only for its own opening balance but for every one near it that leads to the same decisions: the
range runs up to the closest accepted row and down to the closest declined one. `_chain` then follows
each card from its true opening balance through these ranges. Where it leaves them, the segment is
walked again from the balance reached. The first such segment of a card is always given its true
balance, so every round settles at least one more, and the result equals the walk of the whole card.

A segment is a number in a column, not a task or a file: parts of the sorted rows, as many as their size asks for,
hold one long segment each or many short ones.
"""

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycard.operators.ledger import LAST, ORDER, run_ledger
from tallycard.operators.rules import BOOKED, GUARDED, VOID
from tallycard.sources.scratch import scratch_dir

# Rows of one card that a single task still walks, in well under a minute. Below, splitting costs more.
HEAVY_ROWS = 5_000_000
# A card of HEAVY_ROWS rows is expected this often in the sample that looks for such cards.
SAMPLE_ROWS = 1_000
# Cards and segments (a few numbers each, or an account) that are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000
# Rows of a part at least, so that short segments do not make as many tasks and files.
PART_ROWS = 100_000

# A segment's part, which its rows are stored by: the upper bits of its number.
PART = "segment_part"
_PART_BITS = 33  # what `monotonically_increasing_id` leaves for the rows of a partition
# Columns of the chain behind the card's own.
_CHAIN = "segment bigint, entry_cents bigint, known boolean"


@dataclass
class HeavyCards:
    """The heavy cards of a table, `count` of them, and the number of segments to cut them into, of `rows_each`."""

    cards: DataFrame
    count: int
    segments: int
    rows_each: int

    def small(self, side):
        """A side with at most a row per heavy card and segment boundary, broadcast if that is few."""
        return F.broadcast(side) if self.count + self.segments <= BROADCAST_ROWS else side

    def only(self, df):
        return self._match(df, self.cards, "left_semi")

    def without(self, df):
        return self._match(df, self.cards, "left_anti")

    def parts(self, segments=None):
        """How many tasks so many segments are worth, by default all."""
        return max(1, math.ceil((segments or self.segments) * self.rows_each / max(self.rows_each, PART_ROWS)))

    def cut(self, rows, path):
        """The rows of heavy cards by (card, time, id), stored with the number of their `segment`.

        Each `rows_each` consecutive rows of a part are a segment. Parts are bounded by range partitioning, whatever a
        card's share of the rows; the numbers rise with (card, time, id).
        """
        part = F.shiftright("segment", _PART_BITS)
        first = F.shiftleft(part, _PART_BITS)
        cut = (
            rows.repartitionByRange(self.parts(), "card_id", *ORDER)
            .sortWithinPartitions("card_id", *ORDER)
            .withColumn("segment", F.monotonically_increasing_id())
            .withColumns({"segment": first + F.floor((F.col("segment") - first) / self.rows_each), PART: part})
        )
        cut.write.partitionBy(PART).parquet(path)
        return rows.sparkSession.read.schema(cut.schema).parquet(path)

    def opened(self, rows, entries, how, extra=("entry_cents",)):
        """Rows of segments with the balance their segment opens with."""
        return self._match(rows, entries, how, ("card_id", "segment"), extra)

    def _match(self, df, side, how, names=("card_id",), extra=()):
        """Join on columns of equal names; NULL matches NULL."""
        side = side.select(*[F.col(name).alias(f"of_{name}") for name in names], *extra)
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in names])
        return df.join(self.small(side), same, how).drop(*[f"of_{name}" for name in names])


def find(transactions, heavy_rows=HEAVY_ROWS):
    """The cards with about `heavy_rows` rows or more, stored for the job; None if there is none.

    Which cards are split decides about the work and not about the result, so a sample of the card
    numbers will do where `heavy_rows` is large: counting all cards would shuffle most of them.
    """
    share = min(1.0, SAMPLE_ROWS / heavy_rows)
    seen = transactions.select("card_id")
    if share < 1:
        seen = seen.sample(share, seed=1)
    sizes = seen.groupBy("card_id").agg(F.count(F.lit(1)).alias("card_rows"))
    heavy = sizes.where(F.col("card_rows") > heavy_rows * share)
    rows, count = heavy.agg(F.sum("card_rows"), F.count(F.lit(1))).first()
    if not count:
        return None
    folder = scratch_dir(transactions.sparkSession, "heavy-cards")
    heavy.write.parquet(f"{folder}/cards")
    return HeavyCards(
        cards=transactions.sparkSession.read.parquet(f"{folder}/cards"),
        count=count,
        # The driver keeps one boundary per segment, so 10^12 heavy rows are 200,000 boundaries.
        segments=max(2, math.ceil(rows / share / heavy_rows)),
        rows_each=heavy_rows,
    )


def _first_guess(rows):
    """Opening balance of each segment if all before it was booked, up to the limit."""
    sums = rows.groupBy("card_id", "segment").agg(
        F.sum(F.when(F.col("kind") >= BOOKED, F.col("cents")).otherwise(0)).alias("moved"),
        F.first("opening_cents").alias("opening_cents"),
        F.first("limit_cents").alias("limit_cents"),
    )
    earlier = Window.partitionBy("card_id").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("moved").over(earlier), F.lit(0).cast("bigint"))
    capped = F.least(
        F.col("opening_cents") + before, F.greatest("opening_cents", "limit_cents")
    )
    return sums.select("card_id", "segment", capped.alias("entry_cents"), "opening_cents")


def _walk(found, rows, entries, number):
    """Per segment: the closing balance, and the range of opening balances with equal decisions."""
    keep = ["card_id", "segment", "entry_cents", "opening_cents", "kind", "cents", "limit_cents"]
    opened = found.opened(rows, entries, "inner")
    walked = run_ledger(opened, keep, ("card_id", "segment"), "entry_cents", last=F.lit(True))
    guarded, balance = F.col("kind") == GUARDED, F.col("balance_cents")
    room = F.when(guarded & F.col("approved"), F.col("limit_cents") - balance)
    excess = F.when(guarded & ~F.col("approved"), balance + F.col("cents") - F.col("limit_cents"))
    return walked.groupBy("card_id", "segment").agg(
        F.first("entry_cents").alias("entry_cents"),
        F.first("opening_cents").alias("opening_cents"),
        F.max(F.when(F.col(LAST), F.col("balance_cents"))).alias("exit_cents"),
        F.min(room).alias("up"),
        (F.min(excess) - 1).alias("down"),
        F.lit(number).alias("number"),
    )


class _Follower:
    """Follows cards from their true opening balance through their segments, walk by walk in the order of (card, segment, number)."""

    def __init__(self):
        self.card, self.segment, self.out = None, None, []

    def take(self, card, segment, entry, opening, leaves, up, down):
        if self.segment is None or card != self.card:
            self.close()
            self.card, self.segment, self.balance, self.fit = card, segment, opening, None
        elif segment != self.segment:
            self.close()
            self.segment, self.fit = segment, None
        shift = self.balance - entry
        if self.fit is None and (up is None or shift <= up) and (down is None or -shift <= down):
            self.fit = leaves - entry
        self.last = leaves

    def close(self):
        """The segment's last walk is taken."""
        if self.segment is None:
            return
        known = self.fit is not None
        self.out.append((self.card, self.segment, self.balance, known))
        # Where it is not known yet: walks tend to meet at the limit, so carry on from the last one's close.
        self.balance = self.balance + self.fit if known else self.last

    def given(self, schema):
        rows, self.out = self.out, []
        columns = zip(*rows) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(column), field.type) for column, field in zip(columns, schema)], schema=schema
        )


_WALKED = ("card_id", "segment", "entry_cents", "opening_cents", "exit_cents", "up", "down")


def _following(batches):
    """The chain of the cards of a partition: a few numbers per segment, none of its transactions."""
    follower, schema = _Follower(), None
    for batch in batches:
        kind = batch.schema.field("card_id").type
        schema = pa.schema(
            [("card_id", kind), ("segment", pa.int64()), ("entry_cents", pa.int64()), ("known", pa.bool_())]
        )
        for walk in zip(*[batch.column(name).to_pylist() for name in _WALKED]):
            follower.take(*walk)
        yield follower.given(schema)
    if schema:
        follower.close()
        yield follower.given(schema)


def _chain(walks):
    """The balance that each segment of a card opens with, as far as the walks tell it."""
    kind = walks.schema["card_id"].dataType.simpleString()
    in_order = walks.repartition("card_id").sortWithinPartitions("card_id", "segment", "number")
    return in_order.select(*_WALKED).mapInArrow(_following, f"card_id {kind}, {_CHAIN}")


def _entries(found, rows, folder):
    """The true opening balance of every segment. Each round reads the parts that hold segments that are still open."""
    spark = rows.sparkSession
    live = rows.where(F.col("kind") != VOID)
    todo, number, still = _first_guess(live), 0, live
    while True:
        _walk(found, still, todo, number).write.parquet(f"{folder}/walks/{number}")
        walks = spark.read.parquet(*[f"{folder}/walks/{n}" for n in range(number + 1)])
        chained = f"{folder}/chain/{number}"
        _chain(walks).write.parquet(chained)
        entries = spark.read.parquet(chained)
        todo, number = entries.where(~F.col("known")), number + 1
        part = F.shiftright("segment", _PART_BITS).alias(PART)
        open_ones = [row[PART] for row in todo.select(part).distinct().collect()]
        if not open_ones:
            return entries
        still = live.where(F.col(PART).isin(open_ones))


def run_heavy_ledger(checked, keep, found, mark_last=False):
    """`run_ledger` for the prechecked rows of heavy cards.

    The rows are written once with their segment, so later steps rely on data and not on
    a physical partitioning; they read the columns and parts they need.
    """
    folder = scratch_dir(checked.sparkSession, "heavy-ledger")
    facts = ["card_id", *ORDER, "kind", "cents", "limit_cents", "opening_cents"]
    columns = list(dict.fromkeys(list(keep) + facts))
    rows = found.cut(checked.select(*columns), f"{folder}/rows")
    entries = _entries(found, rows.select(PART, "segment", *facts), folder)
    # Rows without an account have no entry and keep a NULL balance.
    if not mark_last:
        opened = found.opened(rows, entries, "left")
        return run_ledger(opened, keep, ("card_id", "segment"), "entry_cents")
    final = F.max("segment").over(Window.partitionBy("card_id")) == F.col("segment")
    opened = found.opened(rows, entries.withColumn("final", final), "left", ("entry_cents", "final"))
    return run_ledger(opened, keep, ("card_id", "segment"), "entry_cents", last=F.coalesce("final", F.lit(False)))
