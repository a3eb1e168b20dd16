"""Chronological replay: transactions land in a folder slice by slice, oldest days first.

A slice is fully written before the next one starts, so a file stream reads them in this order.
"""

import time
from itertools import accumulate

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.operators import heavy
from tallycard.operators.days import DAY, day_counts, transactions_between
from tallycard.operators.heavy import HEAVY_ROWS
from tallycard.operators.ledger import ORDER
from tallycard.sources.scratch import scratch_dir

# A column of the stored rows of heavy cards.
WAVE = "replay_wave"
# A wave of so many segments or fewer has a file of each; more of them share files, of about `heavy.PART_ROWS` rows at most.
WAVE_FILES = 64


def day_ranges(transactions, count):
    """At most `count` ranges of days with about equally many rows, as (first, last) dates.

    Rows without a time come first in each card's order; if there are any, they are a range of their own
    before the others, (None, None). The driver sees one number per calendar day.
    """
    days = day_counts(transactions).select(F.to_date("date").alias("day"), "transactions").collect()
    timed = [row for row in days if row["day"] is not None]
    upto = list(accumulate(row["transactions"] for row in timed))
    ranges = {}
    for row, rows in zip(timed, upto):
        part = (rows - 1) * count // upto[-1]
        first, _ = ranges.get(part, (row["day"], None))
        ranges[part] = (first, row["day"])
    untimed = [(None, None)] if len(timed) < len(days) else []
    return untimed + list(ranges.values())


def _layout(folder, by_card):
    """The part of the landing folder for one layout; rows of the two never meet in a micro-batch."""
    return f"{folder}/{'by_card' if by_card else 'as_read'}"


def waves(transactions, heavy_rows=HEAVY_ROWS):
    """The rows as frames to be written one after the other, in which no card has more than about `heavy_rows` rows.

    In a frame each card's rows are in one partition, in order, and they come before those in the next frame. Where no card
    is that heavy, there is one frame. Otherwise the rows of heavy cards are cut by (card, time, id) into segments
    and stored; a card's first segment goes with the light cards, its second one into the next frame, and so on. So there are as
    many frames as segments of the heaviest card, and each frame's work is spread over the cards it holds, in files whose
    number grows with the rows and not with the segments.
    """
    found = heavy.find(transactions, heavy_rows)
    if found is None:
        yield _by_card(transactions)
        return
    folder = scratch_dir(transactions.sparkSession, "waves")
    stored, held = _numbered(found, found.cut(found.only(transactions), f"{folder}/segments"), f"{folder}/waves")
    yield _by_card(found.without(transactions).unionByName(stored.where(F.col(WAVE) == 0).drop(WAVE)))
    for wave in range(1, len(held)):
        files = max(min(held[wave], WAVE_FILES), found.parts(held[wave]))
        yield _by_card(stored.where(F.col(WAVE) == wave).drop(WAVE), files)


def _by_card(rows, files=None):
    dealt = rows.repartition(files, "card_id") if files else rows.repartition("card_id")
    return dealt.sortWithinPartitions("card_id", *ORDER)


def _numbered(found, cut, path):
    """The rows stored by the wave they belong to, and how many cards each wave holds.

    A card's first segment belongs to wave 0, its second one to wave 1, and so on. The driver sees one number per wave.
    """
    segments = cut.select("card_id", "segment").distinct()
    place = F.row_number().over(Window.partitionBy("card_id").orderBy("segment")) - 1
    segments.withColumn(WAVE, place).write.parquet(f"{path}-of-segments")
    segments = cut.sparkSession.read.parquet(f"{path}-of-segments")
    held = dict(segments.groupBy(WAVE).agg(F.count(F.lit(1))).collect())
    rows = found.opened(cut, segments, "inner", (WAVE,)).drop("segment", heavy.PART)
    # By range, so that a file holds one wave or a few, and a large wave has many files.
    dealt = rows.repartitionByRange(found.parts(), WAVE, "card_id")
    dealt.write.partitionBy(WAVE).parquet(path)
    return rows.sparkSession.read.schema(dealt.schema).parquet(path), [held[wave] for wave in range(len(held))]


def replay(transactions, folder, ranges, by_card=False, heavy_rows=HEAVY_ROWS, tick=1.0):
    """Append each range of days to the landing folder, one job after the other.

    Without `by_card` a slice is written as it is read; a micro-batch then takes whole slices. With
    `by_card` the rows of a card in a slice are in one file, sorted, so that a micro-batch may end
    after any file without putting a card's rows out of order. A card with more than about `heavy_rows` rows in a slice is in
    several files, which are written one after the other (`waves`), at least `tick` seconds apart: a file
    stream reads them by the time they were written at, and some stores keep no more than its seconds.
    """
    for first, last in ranges:
        part = transactions_between(transactions, first, last).drop(DAY)
        if not by_card:
            part.write.mode("append").parquet(_layout(folder, by_card))
            continue
        for number, wave in enumerate(waves(part, heavy_rows)):
            if number:
                time.sleep(tick)
            wave.write.mode("append").parquet(_layout(folder, by_card))


def landed(spark, folder, schema, by_card=False, max_bytes=256 * 2**20, max_files=None):
    """What `replay` has landed with the same `by_card`, as a stream, oldest files first.

    With `by_card` a micro-batch takes files up to `max_bytes` (at least one) or up to `max_files`, or
    everything if both are None. Without it, a file may hold any rows of a card, so a micro-batch takes
    everything that has landed. Rows that landed in the other layout are not found: the folder is missing.
    """
    options = {}
    if by_card:
        limit = {"maxFilesPerTrigger": max_files} if max_files else {"maxBytesPerTrigger": max_bytes}
        options = {name: str(value) for name, value in limit.items() if value}
    elif max_files:
        raise ValueError("a micro-batch can end between files only if they are laid by card")
    return spark.readStream.schema(schema).options(**options).parquet(_layout(folder, by_card))
