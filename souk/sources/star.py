"""The marketplace tables derived from a star schema of orders and line items.

Every column is integer or decimal arithmetic on the source keys, so another
engine can rebuild it exactly. Ids keep the source's integer type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.schema import MONEY, Tables


# Columns and types of the source files; naming them saves a job per file.
SOURCES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
                " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
            " p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_star(spark: SparkSession, folder: str) -> Tables:
    """Tables over the parquet files of ``folder``."""

    def source(name: str) -> DataFrame:
        return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")

    return Tables(
        customers=lambda: _customers(source("orders"), source("customer"), source("nation")),
        orders=lambda: _orders(source("orders")),
        products=lambda: _products(source("part")),
        sellers=lambda: _sellers(source("supplier"), source("nation")),
        order_items=lambda: _items(source("lineitem")),
        order_payments=lambda: _payments(source("orders")),
        order_reviews=lambda: _reviews(source("orders")),
        product_category_translation=lambda: _translation(_products(source("part"))),
    )


def expected_rows(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows that the tables of ``folder`` must have, counted in the sources by its rules."""

    def rows(name: str) -> DataFrame:
        return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")

    key = F.col("o_orderkey")
    counts = rows("orders").agg(
        F.count("*").alias("orders"),
        F.count("*").alias("customers"),
        (F.count_if(key % 97 != 0) + F.count_if(key % 20 == 0)).alias("order_payments"),
        (F.count_if(key % 113 != 0) + F.count_if(key % 50 == 7)).alias("order_reviews"),
    ).first().asDict()
    others = {"order_items": "lineitem", "products": "part", "sellers": "supplier"}
    return counts | {table: rows(name).count() for table, name in others.items()}


def _zip(key: str) -> Column:
    return F.lpad((F.col(key) % 100000).cast("string"), 5, "0")


def _amount(column: str) -> Column:
    """A double that holds whole cents as money; quicker than Spark's cast by way of text."""
    cents = F.rint(F.col(column) * 100).cast("bigint")
    return (cents.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def _customers(orders: DataFrame, customer: DataFrame, nations: DataFrame) -> DataFrame:
    people = customer.join(nations, customer.c_nationkey == nations.n_nationkey)
    return orders.join(people, orders.o_custkey == people.c_custkey).select(
        F.col("o_orderkey").alias("customer_id"),
        (F.col("o_custkey") * 8 + F.col("o_orderkey") % 8).alias("customer_unique_id"),
        _zip("o_custkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _orders(orders: DataFrame) -> DataFrame:
    key, placed = F.col("o_orderkey"), F.col("o_orderdate")
    arrived = (F.col("o_orderstatus") == "F") & (key % 50 != 0)
    hours = F.make_dt_interval(F.lit(0), (key * 7919 % 900).cast("int"))
    return orders.select(
        key.alias("order_id"),
        key.alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled").alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        (placed + F.make_dt_interval(F.lit(1))).alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.when(arrived, placed + hours).alias("order_delivered_customer_date"),
        (placed + F.make_dt_interval(F.lit(20))).alias("order_estimated_delivery_date"),
    )


def _payments(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")

    def payment(number: int, kind: Column, value: Column) -> Column:
        return F.struct(
            F.lit(number).alias("payment_sequential"),
            kind.alias("payment_type"),
            (1 + key % 10).cast("int").alias("payment_installments"),
            value.cast(MONEY).alias("payment_value"),
        )

    value = F.expr("cast(round(o_totalprice * 100) AS bigint) DIV 500 * 0.01")
    main = payment(1, F.when(key % 4 == 0, "boleto").otherwise("credit_card"), value)
    voucher = payment(2, F.lit("voucher"), key % 500)
    return (
        orders.select(
            key.alias("order_id"),
            F.explode(
                F.array(F.when(key % 97 != 0, main), F.when(key % 20 == 0, voucher))
            ).alias("payment"),
        )
        .filter(F.col("payment").isNotNull())
        .select("order_id", "payment.*")
    )


def _reviews(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    rank = key * 31 % 100
    score = (
        F.when(rank < 58, 5).when(rank < 77, 4).when(rank < 85, 3).when(rank < 88, 2).otherwise(1)
    )
    return (
        orders.select(
            key.alias("review_id"),
            key.alias("order_id"),
            F.explode(
                F.array(F.when(key % 113 != 0, score), F.when(key % 50 == 7, F.lit(1)))
            ).alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.lit(None).cast("string").alias("review_comment_message"),
            F.col("o_orderdate").alias("review_creation_date"),
            F.col("o_orderdate").alias("review_answer_timestamp"),
        )
        .filter(F.col("review_score").isNotNull())
    )


def _items(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _amount("l_extendedprice").alias("price"),
        _amount("l_quantity").alias("freight_value"),
    )


def _products(parts: DataFrame) -> DataFrame:
    category = F.concat(
        F.lower("p_type"), F.lit("_"), F.split_part("p_name", F.lit(" "), F.lit(2))
    )
    size = F.col("p_size").cast("int")
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, category).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_name").alias("product_description_lenght"),
        F.lit(1).alias("product_photos_qty"),
        size.alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def _sellers(supplier: DataFrame, nations: DataFrame) -> DataFrame:
    return supplier.join(nations, supplier.s_nationkey == nations.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        _zip("s_suppkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def _translation(products: DataFrame) -> DataFrame:
    name = F.col("product_category_name")
    return products.filter(name.contains("g")).select(
        name, F.upper(name).alias("product_category_name_english")
    ).distinct()
