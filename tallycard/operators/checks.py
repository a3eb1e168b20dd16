"""Data checks: keys, completeness, money precision."""

from functools import reduce

from pyspark.sql import functions as F

from tallycard import schemas
from tallycard.functions.money import off_cent
from tallycard.sources.scratch import scratch_dir


def key_violations(df, key):
    """Key values which are NULL or occur more than once, with their number of rows."""
    sizes = df.groupBy(F.col(key).alias("key_value")).agg(F.count(F.lit(1)).alias("key_rows"))
    return sizes.where((F.col("key_rows") > 1) | F.col("key_value").isNull())


def primary_key_check(tables):
    """One row per table: rows, NULL keys and key values that occur more than once."""

    def check(name):
        key = F.col(schemas.PRIMARY_KEYS[name]).alias("key_value")
        sizes = tables[name].groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
        missing, repeated = F.col("key_value").isNull(), F.col("key_rows") > 1

        def total(column):
            return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))

        return sizes.agg(
            F.lit(name).alias("table_name"),
            total(F.col("key_rows")).alias("table_rows"),
            total(F.when(missing, F.col("key_rows"))).alias("null_keys"),
            F.count(F.when(repeated & ~missing, 1)).alias("repeated_keys"),
        )

    return reduce(lambda one, other: one.unionByName(other), [check(name) for name in tables])


def _day(expected, processed, time):
    """The day of a row; all rows are of one day if a side does not know their time."""
    known = time in expected.columns and time in processed.columns
    return F.to_date(time) if known else F.lit(None).cast("date")


def _fingerprints(rows, key, day, side):
    """For each day: the number of rows, and two sums of hashes of their keys, which do not depend on the order of the rows."""
    first, second = (F.xxhash64(key, F.lit(seed)).cast("decimal(20,0)") for seed in (1, 2))
    return rows.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(first).alias("first"), F.sum(second).alias("second")
    ).select("day", F.struct("rows", "first", "second").alias(side))


def day_differences(expected, processed, key, time="timestamp"):
    """One row per day of either side: `day`, the rows `e` and `p` of both sides, and whether the keys `differ`.

    Keys are compared by fingerprints of all keys of a day, so a day sends one row per task. Two sets of as many keys that differ
    pass for equal about once in 10^38.
    """
    day = _day(expected, processed, time)
    sides = _fingerprints(expected, key, day, "e").withColumn("p", F.lit(None)).unionByName(
        _fingerprints(processed, key, day, "p").withColumn("e", F.lit(None))
    )
    days = sides.groupBy("day").agg(F.max("e").alias("e"), F.max("p").alias("p"))

    def rows(side):
        return F.coalesce(F.col(f"{side}.rows"), F.lit(0).cast("bigint")).alias(side)

    return days.select("day", rows("e"), rows("p"), (~F.col("e").eqNullSafe(F.col("p"))).alias("differ"))


def _by_key(expected, processed, key):
    """How many rows the keys have too few (`lost`) and too many (`doubled`) on the processed side."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    sides = expected.select(F.col(key), one.alias("e"), zero.alias("p")).unionByName(
        processed.select(F.col(key), zero.alias("e"), one.alias("p"))
    )
    keys = sides.groupBy(key).agg(F.sum("e").alias("e"), F.sum("p").alias("p"))
    return keys.agg(
        F.coalesce(F.sum(F.greatest(F.col("e") - F.col("p"), zero)), zero).alias("lost"),
        F.coalesce(F.sum(F.greatest(F.col("p") - F.col("e"), zero)), zero).alias("doubled"),
    )


def completeness(expected, processed, key, time="timestamp"):
    """The gate before the batch job: rows of both sides, how many keys were `lost` or `doubled`, and the result.

    `lost` counts the rows that a key has too few on the processed side, `doubled` those it has too many. The result
    is `ok`, `short`, `over`, or `short and over`. Days are compared first, when this is called; only the rows of days that
    differ are compared key by key, so where all is well no key is shuffled.
    """
    spark, path = expected.sparkSession, scratch_dir(expected.sparkSession, "days")
    day_differences(expected, processed, key, time).write.parquet(path)
    days = spark.read.schema("day date, e bigint, p bigint, differ boolean").parquet(path)
    zero = F.lit(0).cast("bigint")
    parts = days.select(F.col("e").alias("expected"), F.col("p").alias("processed"), zero.alias("lost"), zero.alias("doubled"))
    # As many rows as the calendar has days.
    odd = days.where("differ").select(F.col("day").alias("odd_day"))
    if not odd.isEmpty():
        same = _day(expected, processed, time).eqNullSafe(F.col("odd_day"))
        sides = [rows.join(F.broadcast(odd), same, "left_semi") for rows in (expected, processed)]
        keys = _by_key(*sides, key)
        parts = parts.unionByName(keys.select(zero.alias("expected"), zero.alias("processed"), "lost", "doubled"))
    found = parts.agg(*[F.coalesce(F.sum(name), zero).alias(name) for name in parts.columns])
    short, over = F.col("lost") > 0, F.col("doubled") > 0
    result = F.when(short & over, "short and over").when(short, "short").when(over, "over").otherwise("ok")
    return found.withColumn("result", result)


def off_cent_amounts(transactions):
    """Transactions whose amount the exact arithmetic cannot hold."""
    return transactions.where(off_cent(F.col("amount")))
