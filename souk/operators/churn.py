"""Churn: has a repeat customer been silent for longer than their own rhythm?"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions import exact
from souk.functions.calendar import whole_days
from souk.operators.orders import last_purchase, placed_orders
from souk.plans.slices import PERSON, Timeline, previous
from souk.schema import Tables


def churn_risk(
    t: Tables, factor: float | Decimal = Decimal("1.5"), ordered: bool = False
) -> DataFrame:
    """People with two orders or more; churned when silent beyond ``factor`` mean gaps.

    Silence is measured at the latest purchase of all orders.
    """
    return churned(order_gaps(placed_orders(t)), last_purchase(t), factor, ordered)


def order_gaps(placed: DataFrame, **more: Column) -> DataFrame:
    """Per person: ``order_count``, ``gaps`` between orders and their ``gap_days`` in all, and
    ``last_order_date``. ``more`` aggregates further of a person's orders.
    """
    bought = F.col("order_purchase_timestamp")
    line = Timeline(placed, ["order_purchase_timestamp", "order_id"])
    rows = line.carry(
        totals={"slice_last": F.max("order_purchase_timestamp")},
        state={"last_before": previous("slice_last")},
    )
    gap = whole_days(
        bought, F.coalesce(F.lag("order_purchase_timestamp").over(line.window), "last_before")
    )
    return (
        rows.select(PERSON, "order_purchase_timestamp", "order_id", gap.alias("gap"))
        .groupBy(PERSON)
        .agg(
            F.count("*").alias("order_count"),
            F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_days"),
            F.count("gap").alias("gaps"),
            F.max("order_purchase_timestamp").alias("last_order_date"),
            *(column.alias(name) for name, column in more.items()),
        )
    )


def churned(
    gaps: DataFrame, last: Column, factor: float | Decimal = Decimal("1.5"), ordered: bool = False
) -> DataFrame:
    """``churn_risk`` of people whose orders ``order_gaps`` summed up, silent until ``last``."""
    people = gaps.filter("order_count > 1").withColumn(
        "avg_days_between", exact.mean(F.col("gap_days"), F.col("gaps"), 1))
    threshold = F.col("avg_days_between") * F.lit(Decimal(str(factor)))
    result = people.withColumns({
        "days_since_last": whole_days(last, F.col("last_order_date")),
        "churn_threshold": F.round(threshold, 1).cast("decimal(18,1)"),
    }).select(
        PERSON, "order_count", "avg_days_between", "last_order_date", "days_since_last",
        "churn_threshold",
        (F.col("days_since_last") > F.col("churn_threshold")).alias("is_churned"),
    )
    return result.orderBy(F.desc_nulls_first("days_since_last"), PERSON) if ordered else result
