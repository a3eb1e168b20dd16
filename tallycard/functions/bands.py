"""Credit-score and credit-limit bands as native column expressions."""

from pyspark.sql import functions as F

# Upper bound of utilisation in percent (inclusive) and score change.
SCORE_BANDS = [(10, 15), (20, 10), (30, 5), (50, -5), (70, -15)]
SCORE_CHANGE_ABOVE = -25

# Upper bound of the score change (inclusive) and the factor on the limit.
LIMIT_BANDS = [(-20, 0.85), (-10, 0.90)]
LIMIT_FACTOR_ABOVE = 0.95


def utilisation(balance, limit):
    """Balance as percent of the limit; NULL when there is no limit to divide by."""
    return F.try_divide(balance.cast("double"), limit.cast("double")) * 100


def score_change(percent):
    """Points added to a credit score. A NULL utilisation changes nothing known: NULL."""
    change = F.when(percent.isNull(), F.lit(None).cast("int"))
    for bound, points in SCORE_BANDS:
        change = change.when(percent <= bound, F.lit(points))
    return change.otherwise(F.lit(SCORE_CHANGE_ABOVE))


def revised_limit(limit, change):
    """A limit after a score change: only falling scores cut it, to a multiple of 100.

    Halves go to the even hundred, hence `bround`. Limits which are not cut are not rounded.
    """
    factor = F.when(change <= LIMIT_BANDS[0][0], F.lit(LIMIT_BANDS[0][1]))
    for bound, share in LIMIT_BANDS[1:]:
        factor = factor.when(change <= bound, F.lit(share))
    factor = factor.otherwise(F.lit(LIMIT_FACTOR_ABOVE))
    return F.when(change >= 0, limit).otherwise(F.bround(limit * factor, -2))
