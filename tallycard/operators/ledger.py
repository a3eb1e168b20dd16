"""The running pending balance of a card: the one operator Spark has no expression for.

Whether a guarded row is booked depends on the balance the rows before it left behind. A window sum
gives the balance as if every row were booked; `settle` then takes the declined rows off again.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycard.operators.rules import BOOKED, GUARDED, VOID

ORDER = ("timestamp", "transaction_id")
# Marks the last row of a card in this order.
LAST = "last_of_card"

# Rows whose greatest value is kept for searches, and rows of a card that are not worth a search.
BLOCK = 64
SHORT = 64
# Runs of fewer rows than NEAR are slower to search than to go through; then STRETCH rows are gone through.
NEAR = 48
STRETCH = 512
_MOST = 2**63 - 1

_HELPERS = ("starts", "kind", "cents", "booked_cents", "limit_cents")


class _Search:
    """Finds the next of consecutive rows whose value is beyond a bound, by the maxima of blocks of rows."""

    def __init__(self, values):
        self.values = values
        self.maxima = np.maximum.reduceat(values, np.arange(0, len(values), BLOCK))

    def next_above(self, start, bound):
        """The first row from `start` on with a value above the bound; the number of rows if there is none."""
        values, maxima, block = self.values, self.maxima, start // BLOCK
        stop = (block + 1) * BLOCK
        found = values[start:stop] > bound
        at = int(found.argmax()) if found.size else 0
        if found.size and found[at]:
            return start + at
        # Blocks in spans that double, so a near one is found at once and a far one soon.
        block, span = block + 1, 16
        while block < len(maxima):
            found = maxima[block : block + span] > bound
            at = int(found.argmax())
            if found[at]:
                begin = (block + at) * BLOCK
                return begin + int((values[begin : begin + BLOCK] > bound).argmax())
            block, span = block + span, span * 2
        return len(values)


def _step_by_step(guarded, cents, booked, limit, off):
    """What declined rows have taken off the balance after each row of one card; `off` is what rows before took off."""
    offs = []
    for is_guarded, amount, total in zip(guarded.tolist(), cents.tolist(), booked.tolist()):
        if is_guarded and total + off > limit:
            off -= amount
        offs.append(off)
    return offs


def _walk(guarded, moving, cents, booked, limit, off):
    """The same as `_step_by_step`, in runs of rows.

    While rows are accepted, the balance is the booked one less what is taken off, so the run ends with the next row
    whose booked balance is too high. While they are declined, the balance stays, and so does the room that the next
    accepted row has to fit in, but for `moving` rows, which are booked anyhow. Where runs are short, a stretch of rows
    is taken row by row.
    """
    size, at = len(booked), 0
    offs = np.empty(size, dtype=np.int64)
    breaks = _Search(np.where(guarded, booked, -_MOST))
    # A row ends a run of declined ones if it fits in the room or moves the balance.
    ends = _Search(np.where(guarded, -cents, np.where(moving, _MOST, -_MOST)))
    declined = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(cents * guarded, out=declined[1:])
    while at < size:
        begin, at = at, breaks.next_above(at, limit - off)
        offs[begin:at] = off
        if at < size:
            room = limit - (int(booked[at]) + off - int(cents[at]))
            end = ends.next_above(at + 1, -room - 1)
            offs[at:end] = (off + int(declined[at])) - declined[at + 1 : end + 1]
            off, at = int(offs[end - 1]), end
        if at - begin < NEAR and at < size:
            own = slice(at, at + STRETCH)
            offs[own] = _step_by_step(guarded[own], cents[own], booked[own], limit, off)
            at = min(size, at + STRETCH)
            off = int(offs[at - 1])
    return offs


def settle(starts, kind, cents, booked, limit, shift):
    """Decide consecutive rows of cards, each card's rows in order.

    `starts` marks the first row of a card, `booked` is the balance with all rows so far booked.
    `shift` is what earlier declined rows took off the balance of the card that row 0 continues.
    Returns (approved, balance, shift to go on with).
    """
    firsts = np.flatnonzero(starts)
    shifts = np.zeros(len(booked), dtype=np.int64)
    shifts[: firsts[0] if len(firsts) else len(booked)] = shift
    guarded = kind == GUARDED
    breaches = np.flatnonzero(guarded & (booked + shifts > limit))
    # Cards that never exceed their limit are done. Others are walked from their first breach on.
    bounds = np.concatenate(([0], firsts, [len(booked)]))
    places = np.searchsorted(breaches, bounds)
    walked = np.flatnonzero(places[:-1] < places[1:])
    for begin, end in zip(breaches[places[walked]].tolist(), bounds[walked + 1].tolist()):
        own = slice(begin, end)
        off, bound = int(shifts[begin]), int(limit[begin])
        if end - begin > SHORT:
            shifts[own] = _walk(guarded[own], kind[own] == BOOKED, cents[own], booked[own], bound, off)
        else:
            shifts[own] = _step_by_step(guarded[own], cents[own], booked[own], bound, off)
    before = np.concatenate(([shift], shifts[:-1])) if len(shifts) else shifts
    before[firsts] = 0
    approved = (kind >= BOOKED) & (booked + before <= limit)
    return approved, booked + shifts, int(shifts[-1]) if len(shifts) else shift


def _numbers(batch, name):
    """A column as numbers. Only rows without a balance may lack any; theirs are never read."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.null_count:
        kind = batch.column(batch.schema.get_field_index("kind"))
        if pc.any(pc.and_(column.is_null(), pc.not_equal(kind, VOID))).as_py():
            raise ValueError(f"a row that is to be booked has no {name}")
        column = column.fill_null(0)
    return column.to_numpy(zero_copy_only=False)


def _settle_batches(keep):
    def task(batches):
        shift = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, kind, cents, booked, limit = (_numbers(batch, name) for name in _HELPERS)
            approved, balance, shift = settle(starts, kind, cents, booked, limit, shift)
            columns = [batch.column(batch.schema.get_field_index(name)) for name in keep]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(approved), pa.array(balance)],
                names=keep + ["approved", "balance_cents"],
            )

    return task


def run_ledger(checked, keep, keys=("card_id",), opening="opening_cents", last=None):
    """Adds `approved` and `balance_cents` to prechecked rows; keeps the columns in `keep`.

    Each group of `keys` is one ledger that opens at `opening`. The window declares distribution and
    order, so an exchange on the card that a join below made already is used again. Strings pass
    through the Python step as Arrow buffers. With a condition `last`, LAST is added: whether the row is the last one
    of its ledger and the condition holds. Totals then need no order.
    """
    keep = list(keep)
    ledger = Window.partitionBy(*keys).orderBy(*ORDER)
    moves = F.when(F.col("kind") >= BOOKED, F.col("cents")).otherwise(F.lit(0).cast("bigint"))
    so_far = ledger.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flag = [] if last is None else [(F.lead(F.lit(1)).over(ledger).isNull() & last).alias(LAST)]
    rows = checked.select(
        *keep,
        *flag,
        (F.row_number().over(ledger) == 1).alias("starts"),
        *[name for name in ("kind", "cents", "limit_cents") if name not in keep],
        (F.col(opening) + F.sum(moves).over(so_far)).alias("booked_cents"),
    )
    keep += [LAST] * len(flag)
    schema = T.StructType(
        [rows.schema[name] for name in keep]
        + [T.StructField("approved", T.BooleanType()), T.StructField("balance_cents", T.LongType())]
    )
    return rows.mapInArrow(_settle_batches(keep), schema)
