"""Hand-written transactions: one good row, and changes to it."""

from __future__ import annotations

from pyspark.sql import types as T

from tillstar import schemas

GOOD = {
    "transaction_id": 1,
    "customer_id": 10,
    "customer_name": "Ann",
    "product_id": 100,
    "price": 5.0,
    "product_name": "Pen",
    "category": "Office",
    "purchase_location": "Online",
    "city": "Oslo",
    "transaction_date": "2024-01-05",
    "quantity": 2,
    "payment_method": "Card",
    "discount": 0.0,
    "email": "ann@x.com",
    "phone": "9876543210",
    "payment_status": "SUCCESSFUL",
}

TAGGED = T.StructType([*schemas.SALES.fields, T.StructField(schemas.SOURCE, T.StringType())])


def sales(spark, *changes: dict):
    rows = [tuple({**GOOD, **change}[c] for c in schemas.SALES.names) for change in changes]
    return spark.createDataFrame(rows, schemas.SALES)


def tagged(spark, *changes: dict):
    """Like ``sales``; a change may name its source in ``src`` (default ``one``)."""
    sources = [c.get("src", "one") for c in changes]
    rows = [
        tuple({**GOOD, **c}[n] for n in schemas.SALES.names) + (s,)
        for c, s in zip(changes, sources)
    ]
    return spark.createDataFrame(rows, TAGGED)


def catalog(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), schemas.CATALOG)
