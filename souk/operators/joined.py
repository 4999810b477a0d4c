"""Order detail, sellers, spenders and order-value tiers."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import exact
from souk.functions.calendar import whole_days
from souk.operators.orders import (
    customer_totals,
    joined_rows,
    order_reviews,
    order_values,
    seller_orders,
)
from souk.plans.tables import materialize
from souk.schema import Tables

# Labels of the seller tiers, fixed values.
STAR = "★ Star Seller"
ABOVE = "● Above Average"
UNDER = "▼ Underperformer"
AVERAGE = "■ Average"


def order_details(t: Tables, k: int | None = 20) -> DataFrame:
    """Items of orders with customer, category and review score, newest order first.

    An order with several reviews repeats its items. ``k=None`` gives all rows,
    unordered. For the first ``k`` the newest ``k`` orders that have an item are enough,
    as each gives a row or more. Those keys, ``k`` at most, are broadcast: reviews are
    scanned without a shuffle, and of items only the test for having one shuffles keys.
    """
    if k is None:
        return _details(_placed(t), t.order_items, t.order_reviews, t)
    newest_first = [F.desc_nulls_first("order_purchase_timestamp"), F.asc_nulls_last("order_id")]
    known = t.order_items.select("order_id", "product_id").join(
        t.products.select("product_id"), "product_id", "left_semi"
    )
    newest = (
        _placed(t).join(known.select("order_id"), "order_id", "left_semi")
        .orderBy(*newest_first).limit(k)
    )
    keys = F.broadcast(newest.select("order_id"))
    return (
        _details(
            F.broadcast(newest), t.order_items.join(keys, "order_id", "left_semi"),
            t.order_reviews.join(keys, "order_id", "left_semi"), t,
        )
        .orderBy(
            *newest_first,
            *(F.asc_nulls_last(c) for c in
              ("order_item_id", "review_score", "product_id", "price", "freight_value")),
        )
        .limit(k)
    )


def _placed(t: Tables) -> DataFrame:
    """Orders that have a customer."""
    orders = t.orders.select("order_id", "customer_id", "order_purchase_timestamp", "order_status")
    people = t.customers.select("customer_id", "customer_unique_id", "customer_state")
    return orders.join(people, "customer_id")


def _details(orders: DataFrame, items: DataFrame, reviews: DataFrame, t: Tables) -> DataFrame:
    # Products are named before they meet the items: few categories, many items of each. Items
    # meet them first, while they are narrow; then all joins are by order, and the columns of
    # orders are shuffled once an order and not once an item.
    names = t.products.select("product_id", "product_category_name").join(
        t.product_category_translation, "product_category_name", "left"
    ).select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
        .alias("product_category_english"),
    )
    columns = ["order_id", "order_item_id", "product_id", "price", "freight_value"]
    return (
        items.select(*columns).join(names, "product_id")
        .join(orders, "order_id")
        .join(reviews.select("order_id", "review_score"), "order_id", "left")
        .select(
            "order_id", "order_purchase_timestamp", "order_status", "customer_unique_id",
            "customer_state", "order_item_id", "product_id", "product_category_english",
            "price", "freight_value", "review_score",
        )
    )


def underperforming_sellers(
    t: Tables, min_items: int = 50, max_avg: float | Decimal = 3
) -> DataFrame:
    """Sellers with at least ``min_items`` reviewed items and a mean score under ``max_avg``.

    An item counts once per review of its order, in every column but ``total_orders``.
    """
    rows = F.col("items") * F.col("reviews")
    scored = (
        seller_orders(t)
        .join(t.orders.select("order_id"), "order_id", "left_semi")
        .join(order_reviews(t), "order_id")
    )
    return (
        scored.groupBy("seller_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum(rows).alias("items_sold"),
            F.sum(F.col("items") * F.col("score_sum")).alias("score_sum"),
            F.sum(F.col("items") * F.col("scores")).alias("scores"),
            exact.money(F.sum(F.col("item_cents") * F.col("reviews"))).alias("total_revenue"),
        )
        .filter(
            (F.col("items_sold") >= min_items)
            & (F.col("score_sum") < F.col("scores") * F.lit(Decimal(str(max_avg))))
        )
        .select(
            "seller_id", "total_orders", "items_sold",
            exact.mean(F.col("score_sum"), F.col("scores"), 2).alias("avg_review_score"),
            "total_revenue",
        )
        .orderBy(
            F.asc_nulls_last("avg_review_score"),
            F.desc_nulls_first("items_sold"),
            F.asc_nulls_last("seller_id"),
        )
    )


def above_average_spenders(t: Tables, k: int = 20) -> DataFrame:
    """The ``k`` people who spent most, of those above the mean spend of all people."""
    # Written, as the average needs fewer columns than the rows: no exchange would be shared.
    spend = materialize(
        customer_totals(t).select(
            "customer_unique_id",
            F.col("frequency").alias("order_count"),
            F.col("monetary").alias("lifetime_spend"),
        )
    )
    average = spend.select(
        exact.quotient(F.sum(exact.cents("lifetime_spend")), F.count("*"))
    ).scalar()
    return (
        spend.filter(exact.cents("lifetime_spend") > average)
        .orderBy(F.desc_nulls_first("lifetime_spend"), F.asc_nulls_last("customer_unique_id"))
        .limit(k)
    )


def order_value_tiers(t: Tables, bounds: Sequence[int] = (50, 200, 500)) -> DataFrame:
    """Orders by value tier, with the mean review of each; tiers end below their bound."""
    low, middle, high = bounds
    labels = [
        f"Low (<R${low})",
        f"Medium (R${low}–{middle})",
        f"High (R${middle}–{high})",
        f"Premium (>R${high})",
    ]
    cents = F.col("order_cents")
    tier = (
        F.when(cents < low * 100, 0).when(cents < middle * 100, 1).when(cents < high * 100, 2)
        .otherwise(3)
    )
    rows = joined_rows()
    return (
        order_values(t)
        .join(t.orders.select("order_id"), "order_id", "left_semi")
        .join(order_reviews(t), "order_id", "left")
        .groupBy(tier.alias("tier"))
        .agg(
            F.sum(rows).alias("order_count"),
            exact.mean(F.sum(cents * rows), F.sum(rows), 2, units=100).alias("avg_order_value"),
            exact.mean(F.sum("score_sum"), F.sum("scores"), 2).alias("avg_review_score"),
        )
        .orderBy("tier")
        .select(
            F.element_at(F.array(*map(F.lit, labels)), F.col("tier") + 1).alias("value_tier"),
            "order_count", "avg_order_value", "avg_review_score",
        )
    )


def seller_performance(t: Tables, min_items: int = 30) -> DataFrame:
    """Sellers of ``min_items`` delivered items or more, graded against their mean.

    Items count once per review of their order (once without any). The platform
    averages are means of the sellers' rounded means.
    """
    delivered = (
        t.orders.filter(F.col("order_status") == "delivered")
        .select(
            "order_id", "customer_id",
            whole_days(
                F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
            ).alias("delta"),
        )
        .join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
    )
    rows = F.col("items") * joined_rows()
    # Written once: the platform means and the rows both read it.
    metrics = materialize(
        seller_orders(t)
        .join(delivered, "order_id")
        .join(order_reviews(t), "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.sum(rows).alias("items_sold"),
            F.count("*").alias("distinct_orders"),
            F.count_distinct("customer_unique_id").alias("unique_customers"),
            exact.money(F.sum(F.col("item_cents") * joined_rows())).alias("total_revenue"),
            exact.mean(
                F.sum(F.col("items") * F.col("score_sum")),
                F.sum(F.col("items") * F.col("scores")), 2,
            ).alias("avg_review"),
            exact.mean(
                F.sum(F.col("delta") * rows), F.sum(F.when(F.col("delta").isNotNull(), rows)), 1
            ).alias("avg_delivery_delta_days"),
        )
        .filter(F.col("items_sold") >= min_items)
        .join(t.sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")
    )
    platform = metrics.select(
        F.struct(
            exact.mean(
                F.sum(F.col("avg_review") * 100), F.count("avg_review"), 2, units=100
            ).alias("review"),
            exact.mean(
                F.sum(F.col("avg_delivery_delta_days") * 10),
                F.count("avg_delivery_delta_days"), 1, units=10,
            ).alias("delta"),
        )
    ).scalar()
    review, delta = F.col("avg_review"), F.col("avg_delivery_delta_days")
    usual_review, usual_delta = F.col("global_avg_review"), F.col("global_avg_delta")
    return (
        metrics.withColumn("platform", platform)
        .withColumns({
            "global_avg_review": F.col("platform.review"),
            "global_avg_delta": F.col("platform.delta"),
        })
        .select(
            "seller_id", "seller_city", "seller_state", "items_sold", "distinct_orders",
            "unique_customers", "total_revenue", "avg_review", "avg_delivery_delta_days",
            "global_avg_review", "global_avg_delta",
            F.when((review >= 4) & (delta < 0), STAR)
            .when((review >= usual_review) & (delta <= usual_delta), ABOVE)
            .when((review < 3) | (delta > 10), UNDER)
            .otherwise(AVERAGE).alias("performance_tier"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("seller_id"))
    )
