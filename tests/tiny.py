"""Hand-made tables: only the columns a test cares about are given."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from souk.schema import SCHEMAS, Tables

_FILLERS = {
    T.StringType: "x", T.IntegerType: 1, T.DecimalType: Decimal("1.00"),
    T.TimestampNTZType: datetime(2018, 1, 1),
}


def tables(spark, **rows) -> Tables:
    """``rows`` maps a table to dicts; required columns left out get a filler."""
    frames = {}
    for name, schema in SCHEMAS.items():
        filled = [
            tuple(
                row.get(f.name, None if f.nullable else _FILLERS[type(f.dataType)])
                for f in schema
            )
            for row in rows.get(name, [])
        ]
        frames[name] = spark.createDataFrame(filled, schema)
    return Tables(**frames)


def shop(spark, purchases) -> Tables:
    """Tables of (order, person, time, payments, reviews); an order is its own customer."""
    orders, customers, payments, reviews = [], [], [], []
    for order, person, time, paid, scores in purchases:
        orders.append({"order_id": order, "customer_id": order, "order_status": "delivered",
                       "order_purchase_timestamp": time})
        customers.append({"customer_id": order, "customer_unique_id": person})
        payments += [{"order_id": order, "payment_sequential": n, "payment_value": Decimal(p)}
                     for n, p in enumerate(paid, 1)]
        reviews += [{"order_id": order, "review_id": order, "review_score": s} for s in scores]
    return tables(spark, orders=orders, customers=customers, order_payments=payments,
                  order_reviews=reviews)


def rows(df, *columns):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
