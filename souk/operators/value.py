"""Customer lifetime value: every paid order with the person's running total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import exact
from souk.operators.orders import paid_orders
from souk.plans.slices import PERSON, Timeline, earlier
from souk.schema import Tables

TIME = ["order_purchase_timestamp", "order_id"]


def customer_ltv(t: Tables, ordered: bool = False) -> DataFrame:
    """Paid orders in purchase order per person, equal times by order id."""
    result = money_of(running_totals(paid_orders(t)))
    return result.orderBy(PERSON, *TIME) if ordered else result


def running_totals(paid: DataFrame) -> DataFrame:
    """``paid`` orders with ``running_cents`` and ``order_sequence`` of their person."""
    line = Timeline(paid, TIME)
    rows = line.carry(
        totals={"slice_cents": F.sum("order_cents"), "slice_orders": F.count("*")},
        state={"cents_before": earlier("slice_cents"), "orders_before": earlier("slice_orders")},
    )
    so_far = line.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        PERSON, *reversed(TIME), "order_cents",
        (F.sum("order_cents").over(so_far) + F.coalesce("cents_before", F.lit(0)))
        .alias("running_cents"),
        (F.row_number().over(line.window) + F.coalesce("orders_before", F.lit(0)))
        .cast("bigint").alias("order_sequence"),
    )


def money_of(running: DataFrame) -> DataFrame:
    return running.select(
        PERSON, *reversed(TIME),
        exact.money(F.col("order_cents")).alias("order_revenue"),
        exact.money(F.col("running_cents")).alias("cumulative_revenue"),
        "order_sequence",
    )
