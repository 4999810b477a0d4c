"""Whole days between timestamps and months as running numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour days from ``earlier`` to ``later``, truncated toward zero.

    Twelve hours either way are zero days, which ``datediff`` would not give.
    """
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def month_number(moment: Column) -> Column:
    """Months since year 0, so that a difference of two counts months across years."""
    return F.year(moment) * 12 + F.month(moment) - 1


def month_start(number: Column) -> Column:
    """First day of a month given by ``month_number``."""
    return F.make_date((number / 12).cast("int"), number % 12 + 1, F.lit(1))
