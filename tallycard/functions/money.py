"""Money columns: DOUBLE at the edges, exact inside.

Sums and comparisons run on whole cents (BIGINT) or DECIMAL(38,2), so their results depend neither
on the order of addition nor on binary fractions. Amounts finer than a cent are out of contract:
`off_cent` finds them, and transactions with a real part of a cent are declined. What is no number of cents at all, as NaN, stops the job; it never becomes
another amount.
"""

from pyspark.sql import functions as F

# Cents are counted in BIGINT.
MOST_CENTS = 2.0**63


def cents(amount):
    """Whole cents as BIGINT. NULL for NULL; NaN and what BIGINT cannot hold raise an error."""
    whole = F.rint(amount * 100)
    text = F.concat(F.lit("not a number of cents: "), amount.cast("string"))
    return (
        F.when(amount.isNull(), F.lit(None).cast("bigint"))
        .when(_countable(amount), whole.cast("bigint"))
        .otherwise(F.raise_error(text).cast("bigint"))
    )


def _countable(amount):
    return ~F.isnan(amount) & (F.abs(F.rint(amount * 100)) < MOST_CENTS)


def from_cents(whole):
    """The DOUBLE nearest to a number of cents."""
    return whole.cast("double") / F.lit(100.0)


def exact(amount):
    """DECIMAL(38,2) form for sums over many rows; NaN raises an error."""
    return amount.cast("decimal(38,2)")


def off_cent(amount):
    """True where an amount has more than two decimals (or is no number of cents)."""
    whole = F.when(_countable(amount), F.rint(amount * 100))
    return F.coalesce(from_cents(whole) != amount, amount.isNotNull())


def has_part_of_cent(amount):
    """True where an amount is finer than a cent by more than sums of binary fractions are off (a millionth)."""
    noise = F.greatest(F.lit(1e-6), F.abs(amount) * 1e-14)
    return F.abs(from_cents(F.rint(amount * 100)) - amount) > noise


def money_text(whole):
    """Shortest text with at least one decimal: 690000 -> 6900.0, 123456 -> 1234.56."""
    plain = (whole.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)").cast("string")
    return F.regexp_replace(plain, "0$", "")
