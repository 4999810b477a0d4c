"""The eight marketplace tables: types, keys and declared constraints.

Column names, lengths and keys are fixed values: files are loaded by them and
the quality jobs check against them. ``product_name_lenght`` and
``product_description_lenght`` are spelt as in the source files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _text(name: str, length: int | None = None, required: bool = True) -> T.StructField:
    metadata = {} if length is None else {"max_length": length}
    return T.StructField(name, T.StringType(), not required, metadata)


def _whole(name: str, required: bool = True) -> T.StructField:
    return T.StructField(name, T.IntegerType(), not required)


def _moment(name: str, required: bool = True) -> T.StructField:
    return T.StructField(name, T.TimestampNTZType(), not required)


def _money(name: str) -> T.StructField:
    return T.StructField(name, MONEY, False)


SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        _text("customer_id", 32),
        _text("customer_unique_id", 32),
        _text("customer_zip_code_prefix", 10),
        _text("customer_city", 100),
        _text("customer_state", 2),
    ]),
    "orders": T.StructType([
        _text("order_id", 32),
        _text("customer_id", 32),
        _text("order_status", 20),
        _moment("order_purchase_timestamp"),
        _moment("order_approved_at", required=False),
        _moment("order_delivered_carrier_date", required=False),
        _moment("order_delivered_customer_date", required=False),
        _moment("order_estimated_delivery_date", required=False),
    ]),
    "products": T.StructType([
        _text("product_id", 32),
        _text("product_category_name", 100, required=False),
        _whole("product_name_lenght", required=False),
        _whole("product_description_lenght", required=False),
        _whole("product_photos_qty", required=False),
        _whole("product_weight_g", required=False),
        _whole("product_length_cm", required=False),
        _whole("product_height_cm", required=False),
        _whole("product_width_cm", required=False),
    ]),
    "sellers": T.StructType([
        _text("seller_id", 32),
        _text("seller_zip_code_prefix", 10),
        _text("seller_city", 100),
        _text("seller_state", 2),
    ]),
    "order_items": T.StructType([
        _text("order_id", 32),
        _whole("order_item_id"),
        _text("product_id", 32),
        _text("seller_id", 32),
        _moment("shipping_limit_date"),
        _money("price"),
        _money("freight_value"),
    ]),
    "order_payments": T.StructType([
        _text("order_id", 32),
        _whole("payment_sequential"),
        _text("payment_type", 30),
        _whole("payment_installments"),
        _money("payment_value"),
    ]),
    "order_reviews": T.StructType([
        _text("review_id", 32),
        _text("order_id", 32),
        _whole("review_score"),
        _text("review_comment_title", required=False),
        _text("review_comment_message", required=False),
        _moment("review_creation_date"),
        _moment("review_answer_timestamp"),
    ]),
    "product_category_translation": T.StructType([
        _text("product_category_name", 100),
        _text("product_category_name_english", 100),
    ]),
}

# review_id is listed although it is known to repeat: the check reports how often.
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_reviews": ("review_id",),
    "product_category_translation": ("product_category_name",),
}

# (table, column, referenced table); the referenced column has the same name.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
]

# Record counts of the published dataset.
PUBLISHED_ROW_COUNTS: dict[str, int] = {
    "customers": 99441,
    "orders": 99441,
    "order_items": 112650,
    "order_payments": 103886,
    "order_reviews": 99224,
    "products": 32951,
    "sellers": 3095,
    "product_category_translation": 71,
}


class Tables:
    """The eight tables as lazy DataFrames; every operator takes one of these.

    ``customers`` has one row per order (``customer_id``); a person is
    ``customer_unique_id``. Ids may be of any orderable type. A table may be given as
    a function that opens it, which is called when an operator first needs it.
    """

    customers: DataFrame
    orders: DataFrame
    products: DataFrame
    sellers: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    product_category_translation: DataFrame

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        if set(tables) != set(SCHEMAS):
            raise ValueError(f"expected the tables {', '.join(SCHEMAS)}")
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in SCHEMAS]
