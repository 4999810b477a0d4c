"""Delivery against the estimate, and what reviewers made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import exact
from souk.functions.calendar import whole_days
from souk.operators.orders import joined_rows, order_reviews
from souk.schema import Tables

# Bucket labels from earliest to latest, fixed values.
EARLY = "Early"
ON_TIME = "On-Time"
LATE = "Late (1–7 days)"
VERY_LATE = "Late (>7 days)"
BUCKETS = [EARLY, ON_TIME, LATE, VERY_LATE]


def delivery_performance(t: Tables, extremes: bool = True) -> DataFrame:
    """Delivered orders by whole days late; an order counts once per review, or once.

    ``extremes=False`` leaves the lowest and highest score out.
    """
    orders = (
        t.orders.select("order_id", days_late().alias("delta")).filter("delta IS NOT NULL")
        .join(order_reviews(t), "order_id", "left").withColumn("rows", joined_rows())
    )
    return summarised(orders, extremes)


def days_late() -> Column:
    """Whole days that a delivered order came late; NULL for any other."""
    return F.when(F.col("order_status") == "delivered", whole_days(
        F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")))


def bucket(delta: Column) -> Column:
    return (
        F.when(delta < 0, EARLY).when(delta == 0, ON_TIME).when(delta <= 7, LATE)
        .otherwise(VERY_LATE)
    )


def summarised(parts: DataFrame, extremes: bool = True) -> DataFrame:
    """Results by bucket of ``delta``, ``rows`` and review sums, of orders or of days."""
    rows, delta = F.col("rows"), F.col("delta")
    result = (
        parts.groupBy(bucket(delta).alias("delivery_bucket"))
        .agg(
            F.sum(rows).alias("order_count"),
            exact.mean(F.sum(delta * rows), F.sum(rows), 1).alias("avg_delta_days"),
            exact.mean(F.sum("score_sum"), F.sum("scores"), 2).alias("avg_review_score"),
            F.min("score_min").cast("decimal(18,2)").alias("min_review"),
            F.max("score_max").cast("decimal(18,2)").alias("max_review"),
            F.min("delta").alias("earliest"),
        )
        # Four rows at most: the window over all of them is small at any scale.
        .withColumn(
            "pct_of_total",
            exact.percent(
                F.col("order_count"), F.sum("order_count").over(Window.partitionBy()), 1
            ),
        )
        .orderBy("earliest")
    )
    columns = ["delivery_bucket", "order_count", "pct_of_total", "avg_delta_days",
               "avg_review_score"]
    return result.select(*columns, *(["min_review", "max_review"] if extremes else []))
