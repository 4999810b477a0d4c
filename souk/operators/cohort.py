"""Monthly cohorts: how many of the people who first bought in a month came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import exact
from souk.functions.calendar import month_number, month_start
from souk.operators.orders import placed_orders
from souk.plans.slices import PERSON
from souk.schema import Tables

# Months per long, one bit each; the sign bit stays clear.
WORD = 63


def cohort_retention(t: Tables) -> DataFrame:
    """Active people per cohort month and months since, as a share of the cohort.

    Months without anybody give no row. A person's active months are bits, so one
    shuffle by person finds both the first month and the later ones, and people alike
    are counted together from there on. The calendar of the orders sets the bits needed.
    """
    month = month_number(F.col("order_purchase_timestamp"))
    start, end = t.orders.agg(F.min(month), F.max(month)).first()
    if start is None:
        start = end = 0
    people = (
        placed_orders(t).select(PERSON, (month - start).alias("offset"))
        .groupBy(PERSON).agg(F.min("offset").alias("first"), *active_months(start, end))
    )
    return retention(people, start, end)


def active_months(start: int, end: int) -> list[Column]:
    """Aggregates of ``offset``, months since ``start``: bits, ``months_0`` and so on."""
    offset = F.col("offset")

    def months_of(word: int) -> Column:
        bit = F.expr(f"shiftleft(1L, offset - {word * WORD})")
        inside = offset.between(word * WORD, word * WORD + WORD - 1)
        return F.bit_or(F.when(inside, bit).otherwise(F.lit(0).cast("bigint")))

    return [months_of(word).alias(name) for word, name in enumerate(_words(start, end))]


def _words(start: int, end: int) -> list[str]:
    return [f"months_{word}" for word in range((end - start) // WORD + 1)]


def retention(people: DataFrame, start: int, end: int) -> DataFrame:
    """``cohort_retention`` of people with their ``first`` month and the bits of active ones."""
    names, offset = _words(start, end), F.col("offset")
    alike = people.groupBy("first", *names).agg(F.count("*").alias("people"))
    word_of = F.element_at(F.array(*names), (offset / WORD).cast("int") + 1)
    activity = (
        alike.withColumn("offset", F.explode(F.sequence("first", F.lit(end - start))))
        .filter(F.getbit(word_of, offset % WORD) == 1)
        .groupBy("first", (offset - F.col("first")).alias("months_since"))
        .agg(F.sum("people").alias("active_customers"))
    )
    # Everybody is active in their own first month, so that row holds the cohort's size.
    size = F.first_value("active_customers").over(
        Window.partitionBy("first").orderBy("months_since")
    )
    return (
        activity.withColumn("cohort_size", size)
        .select(
            month_start(F.col("first") + start).alias("cohort_month"),
            "cohort_size", "months_since", "active_customers",
            exact.percent(F.col("active_customers"), F.col("cohort_size"), 2)
            .alias("retention_rate"),
        )
        .orderBy("cohort_month", "months_since")
    )
