"""Money and ratio arithmetic.

Money arrives as DOUBLE. A double sum depends on the order rows are added in,
which on a cluster depends on partitioning; summing as DECIMAL makes every total
exact and reproducible (and partial sums can be combined in any order, which is
what lets aggregates be pushed below joins).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
WIDE_INT = "decimal(38,0)"


def money_total(amount: Column) -> Column:
    """Aggregate: exact sum of a DOUBLE money column, as DECIMAL."""
    return F.sum(amount.cast(MONEY))


def money(total: Column) -> Column:
    """A decimal total rounded to cents (half away from zero) as DOUBLE."""
    return F.round(total, 2).cast("double")


def money_cents(total: Column) -> Column:
    """A decimal total rounded to cents, as an integral DECIMAL(38,0) count of cents."""
    return (F.round(total, 2) * F.lit(100)).cast(WIDE_INT)


def rounded_ratio(num: Column, den: Column, scale: int = 2, factor: int = 1) -> Column:
    """``ROUND(num * factor / den, scale)`` computed exactly.

    ``num`` and ``den`` are integral (counts, or cents from ``money_cents``). The
    quotient is rounded half away from zero on the exact rational value, with
    integer arithmetic only, so the result does not depend on how a double
    happens to represent a midpoint. A zero or NULL denominator gives NULL.
    """
    n = F.abs(num).cast(WIDE_INT) * F.lit(2 * factor * 10**scale).cast(WIDE_INT)
    d = F.abs(den).cast(WIDE_INT)
    x = n + d
    y = d * F.lit(2).cast(WIDE_INT)
    q = ((x - F.pmod(x, y)) / y).cast(WIDE_INT)  # exact: x - x mod y is a multiple of y
    signed = F.when((num < 0) != (den < 0), -q).otherwise(q)
    return F.when(den != 0, signed.cast("double") / F.lit(float(10**scale)))
