"""Volumes, revenue and reviews: one or two tables each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import exact
from souk.schema import Tables


def total_revenue(t: Tables) -> DataFrame:
    """What customers paid, freight included."""
    return t.order_payments.agg(F.sum("payment_value").alias("total_revenue"))


def total_orders(t: Tables) -> DataFrame:
    return t.orders.agg(F.count_distinct("order_id").alias("total_orders"))


def top_products(t: Tables, k: int = 10) -> DataFrame:
    """The ``k`` products sold most often; equal ones by id."""
    return (
        t.order_items.groupBy("product_id")
        .agg(F.count("*").alias("units_sold"),
             exact.money(F.sum(exact.cents("price"))).alias("total_product_revenue"))
        .orderBy(F.desc_nulls_first("units_sold"), F.asc_nulls_last("product_id"))
        .limit(k)
    )


def orders_by_state(t: Tables) -> DataFrame:
    return (
        t.orders.select("order_id", "customer_id")
        .join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state").agg(F.count("order_id").alias("order_count"))
        .orderBy(F.desc_nulls_first("order_count"), F.asc_nulls_last("customer_state"))
    )


def avg_review_score(t: Tables) -> DataFrame:
    return t.order_reviews.agg(
        exact.mean(F.sum("review_score"), F.count("review_score"), 2).alias("avg_review_score"),
        F.count("*").alias("total_reviews"),
    )


def orders_in_range(
    t: Tables, start: str = "2018-01-01", end: str = "2018-04-01", k: int = 20
) -> DataFrame:
    """The first ``k`` orders bought from ``start`` until just before ``end``."""
    bought = F.col("order_purchase_timestamp")
    return (
        t.orders
        .filter((bought >= F.lit(start).cast("timestamp_ntz"))
                & (bought < F.lit(end).cast("timestamp_ntz")))
        .select("order_id", "order_purchase_timestamp", "order_status")
        .orderBy(F.asc_nulls_last("order_purchase_timestamp"), F.asc_nulls_last("order_id"))
        .limit(k)
    )


def orders_by_status(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy("order_status").agg(F.count("*").alias("order_count"))
        .orderBy(F.desc_nulls_first("order_count"), F.asc_nulls_last("order_status"))
    )


def categories_like(t: Tables, pattern: str = "%moveis%") -> DataFrame:
    """Distinct category names that match ``pattern`` in any letter case."""
    return (
        t.products.select("product_category_name")
        .filter(F.col("product_category_name").ilike(pattern))
        .distinct()
        .orderBy("product_category_name")
    )


def top_payments(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` largest single payments."""
    columns = ["order_id", "payment_type", "payment_installments", "payment_value"]
    return (
        t.order_payments.select(*columns, "payment_sequential")
        .orderBy(
            F.desc_nulls_first("payment_value"),
            F.asc_nulls_last("order_id"),
            F.asc_nulls_last("payment_sequential"),
        )
        .limit(k).select(*columns)
    )


def state_revenue_summary(t: Tables) -> DataFrame:
    """Orders and payments per state; the average is per payment, not per order."""
    payments = t.order_payments.groupBy("order_id").agg(
        F.sum(exact.cents("payment_value")).alias("paid"),
        F.count("*").alias("payments"),
        F.min("payment_value").alias("smallest"),
        F.max("payment_value").alias("largest"),
    )
    return (
        payments.join(t.orders.select("order_id", "customer_id"), "order_id")
        .join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(
            F.count("*").alias("total_orders"),
            exact.money(F.sum("paid")).alias("total_revenue"),
            exact.mean(F.sum("paid"), F.sum("payments"), 2, units=100).alias("avg_payment"),
            F.min("smallest").alias("min_payment"),
            F.max("largest").alias("max_payment"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("customer_state"))
    )


def monthly_orders(t: Tables) -> DataFrame:
    return (
        t.orders
        .groupBy(F.trunc("order_purchase_timestamp", "month").alias("order_month"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("order_month")
    )


def review_distribution(t: Tables) -> DataFrame:
    """Reviews per score and their share, over the handful of scores there are."""
    everything = Window.partitionBy()
    return (
        t.order_reviews.groupBy("review_score").agg(F.count("*").alias("review_count"))
        .withColumn(
            "pct_of_total",
            exact.percent(F.col("review_count"), F.sum("review_count").over(everything), 1),
        )
        .orderBy(F.asc_nulls_last("review_score"))
    )
