"""Money as whole cents, and averages rounded half away from zero without binary error.

Adding longs is cheaper than adding decimals and shuffles fewer bytes; an overflow
fails the query. Spark's ``avg`` of a decimal is itself rounded to four extra digits
and the average of a double is binary, and either can move a tie to the wrong side. A
decimal(20) divided by a decimal(20) keeps 18 digits, so the one rounding that remains
is the one asked for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: str | Column) -> Column:
    """A decimal amount with two fraction digits as a long."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return (column * 100).cast("bigint")


def money(cents: Column) -> Column:
    """Whole cents as a decimal amount."""
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    return (cents.cast("decimal(20,0)") * hundredth).cast("decimal(20,2)")


def quotient(total: Column, count: Column) -> Column:
    """``total / count`` of whole numbers; NULL when there is nothing to count."""
    return total.cast("decimal(20,0)") / F.nullif(count.cast("decimal(20,0)"), F.lit(0))


def mean(total: Column, count: Column, digits: int, units: int = 1) -> Column:
    """Mean of ``count`` values that add up to ``total``, rounded to ``digits``.

    ``total`` is a whole number, of ``units`` to one: 100 for cents.
    """
    return F.round(quotient(total, count * units), digits).cast(f"decimal(18,{digits})")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a percentage of ``whole``; both are counts."""
    return mean(part * 100, whole, digits)
