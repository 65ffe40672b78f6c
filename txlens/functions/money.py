"""Sums and means of money columns.

Amounts are added as integers: millions, units, millionths and millionths of those apart.
A total then does not depend on how the rows were partitioned or on which task was retried,
and up to twelve decimals are summed without any rounding. The parts stay within a bigint for
9e9 rows of 1e15, or 9e12 rows of 1e12. Amounts of 1e15 and more have no use for decimals and are
added as doubles, infinite ones included; NaN is left out, like NULL.
"""

from pyspark.sql import functions as F

#: Every part counts millionths of the one before.
PART = 1_000_000
LARGE = 1e15


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def known(value):
    """The value as a double, NULL for NaN."""
    value = _column(value).cast("double")
    return F.when(~F.isnan(value), value)


def money_sum(value):
    value = known(value)
    small = F.when(F.abs(value) < LARGE, value)
    whole = F.floor(small)
    part = (small - whole) * PART
    millionths = F.floor(part)
    rest = F.rint((part - millionths) * PART).cast("bigint")
    millions = F.floor(whole / PART)
    total = F.lit(0).cast("decimal(38,0)")
    for piece in (millions, whole - millions * PART, millionths, rest):
        total = (total * PART + F.sum(piece)).cast("decimal(38,0)")
    # the exact number of 1e-12 parts, rounded once
    exact = F.concat(total.cast("string"), F.lit("E-12")).cast("double")
    large = F.sum(F.when(F.abs(value) >= LARGE, value))
    return F.when(F.count(value) > 0, F.coalesce(exact, F.lit(0.0)) + F.coalesce(large, F.lit(0.0)))


def money_avg(value):
    return F.try_divide(money_sum(value), F.count(known(value)))


def round_half_up(value, digits):
    """Round the decimal value, so that binary noise does not decide a tie.

    Values of 1e15 and more have no decimals to round and stay as they are.
    """
    value = _column(value).cast("double")
    small = F.when(F.abs(value) < LARGE, value)
    return F.when(F.abs(value) >= LARGE, value).otherwise(
        F.round(small.cast("decimal(28,9)"), digits).cast("double"))


def percentage(part, whole, digits):
    """``part`` of ``whole`` in percent; 0 when there is nothing to divide by."""
    share = F.try_divide(_column(part).cast("double"), _column(whole).cast("double"))
    return F.coalesce(round_half_up(share * 100, digits), F.lit(0.0))
