"""Per-order frames the other operators start from.

Payments and reviews are folded to one row per order before any join. A join then
meets each order once, a heavily repeated order is reduced before it is shuffled,
and the repetition a plain join would cause is kept as a count to multiply by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.exact import cents, money
from souk.plans.deal import dealt
from souk.schema import Tables


def order_values(t: Tables) -> DataFrame:
    """``order_id, order_cents``: what was paid per order."""
    return t.order_payments.groupBy("order_id").agg(
        F.sum(cents("payment_value")).alias("order_cents")
    )


def order_reviews(t: Tables) -> DataFrame:
    """``order_id, reviews, scores, score_sum, score_min, score_max`` of reviewed orders.

    ``reviews`` repeat an order's rows; only the ``scores`` among them that are not NULL
    count in a mean.
    """
    return t.order_reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"),
        F.count("review_score").alias("scores"),
        F.sum("review_score").alias("score_sum"),
        F.min("review_score").alias("score_min"),
        F.max("review_score").alias("score_max"),
    )


def joined_rows() -> Column:
    """Rows an order gives when left-joined to its reviews: one even without any."""
    return F.coalesce("reviews", F.lit(1))


def seller_orders(t: Tables) -> DataFrame:
    """``seller_id, order_id, items, item_cents``: a seller's share of an order.

    Items are dealt by order, which serves this aggregate and any join by order after it: all
    of them in one stage, so parts follow the number of items. Counts them, which runs a job.
    """
    items = dealt(t.order_items.select("seller_id", "order_id", "price"), "order_id")
    return items.groupBy("seller_id", "order_id").agg(
        F.count("*").alias("items"), F.sum(cents("price")).alias("item_cents")
    )


def paid_orders(t: Tables) -> DataFrame:
    """``customer_unique_id, order_id, order_purchase_timestamp, order_cents``."""
    orders = t.orders.select("order_id", "customer_id", "order_purchase_timestamp")
    people = t.customers.select("customer_id", "customer_unique_id")
    return (
        order_values(t).join(orders, "order_id").join(people, "customer_id").drop("customer_id")
    )


def placed_orders(t: Tables) -> DataFrame:
    """``customer_unique_id, order_id, order_purchase_timestamp`` of every order."""
    orders = t.orders.select("order_id", "customer_id", "order_purchase_timestamp")
    people = t.customers.select("customer_id", "customer_unique_id")
    return orders.join(people, "customer_id").drop("customer_id")


def last_purchase(t: Tables) -> Column:
    """The latest purchase of all orders, paid or not, as a scalar subquery."""
    return t.orders.select(F.max("order_purchase_timestamp")).scalar()


def customer_totals(t: Tables) -> DataFrame:
    """Per person: ``frequency`` paid orders, ``monetary`` paid, ``last_order_date``."""
    return paid_orders(t).groupBy("customer_unique_id").agg(
        F.count("*").alias("frequency"),
        money(F.sum("order_cents")).alias("monetary"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
    )
