"""Money and ratios in integers, so that results do not depend on row order.

Averages of doubles differ in their last bits with the order rows arrive in,
which on a cluster is never the same twice. Sums of integer cents do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Amount with two decimals as a whole number of cents."""
    return (amount.cast("decimal(18,2)") * 100).cast("bigint")


def squared_cents(amount: Column) -> Column:
    wide = cents(amount).cast("decimal(19,0)")
    return (wide * wide).cast("decimal(38,0)")


def money(total_cents: Column) -> Column:
    """Cents back to currency units, as a double."""
    return total_cents.cast("double") / F.lit(100.0)


def mean_money(count: Column, total_cents: Column) -> Column:
    """Average in currency units; NULL when nothing was counted."""
    return F.try_divide(money(total_cents), count.cast("double"))


def sample_stddev_money(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares in cents.

    The numerator ``n * sum(c^2) - sum(c)^2`` is exact while it fits 38 digits;
    past that it is taken in doubles. NULL below two values.
    """
    n = count.cast("decimal(20,0)")
    s = total.cast("decimal(38,0)")
    exact = F.try_subtract(
        F.try_multiply(n, squares.cast("decimal(38,0)")), F.try_multiply(s, s)
    ).cast("double")
    n_double, s_double = count.cast("double"), total.cast("double")
    rounded = F.greatest(
        n_double * squares.cast("double") - s_double * s_double, F.lit(0.0)
    )
    spread = F.sqrt(F.coalesce(exact, rounded) / (n_double * (n_double - 1))) / F.lit(100.0)
    return F.when(count > 1, spread)


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(numerator / denominator, digits)`` for integers, half away from zero.

    NULL when the denominator is zero or NULL.
    """
    scaled = F.abs(numerator).cast("decimal(38,0)") * F.lit(2 * 10**digits).cast("decimal(18,0)")
    below = denominator.cast("decimal(38,0)")
    whole = F.call_function(
        "div",
        (scaled + below).cast("decimal(38,0)"),
        F.nullif(below * F.lit(2).cast("decimal(1,0)"), F.lit(0)).cast("decimal(38,0)"),
    )
    return F.sign(numerator) * whole.cast("double") / F.lit(float(10**digits))


def rounded_percent(part: Column, total: Column, digits: int) -> Column:
    return rounded_ratio(part * 100, total, digits)
