"""Table contracts: column names, types and the roles the rules refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SALES = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("purchase_location", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("transaction_date", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("payment_status", T.StringType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)

DIM_PRODUCT = CATALOG

DIM_CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email_hash", T.StringType()),
        T.StructField("phone_hash", T.StringType()),
    ]
)

FACT_SALES = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("valid_quantity", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("purchase_mode", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("valid_discount", T.StringType()),
        T.StructField("payment_status", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("time", T.TimestampType()),
    ]
)

FINDINGS = T.StructType(
    [
        T.StructField("finding", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)

REJECTED_SALES = T.StructType(
    [
        *SALES.fields,
        T.StructField("src", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

LOST_VALUES = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# Tag telling which of the transaction sources a row came from.
SOURCE = "src"

# Columns that must hold a value, per published table.
PRODUCT_REQUIRED = ["product_id", "product_name", "category", "price"]
CUSTOMER_REQUIRED = ["customer_id", "customer_name", "email", "phone"]
CUSTOMER_NOT_BLANK = ["customer_id", "customer_name", "email"]
SALES_REQUIRED = [
    "transaction_id",
    "customer_id",
    "product_id",
    "quantity",
    "discount",
    "transaction_date",
    "city",
    "purchase_location",
    "payment_method",
    "payment_status",
]
SALES_NOT_BLANK = [
    "city",
    "purchase_location",
    "payment_method",
    "payment_status",
    "transaction_date",
]

# Columns whose value lists are worth reading in full.
DOMAIN_COLUMNS = [
    "payment_method",
    "payment_status",
    "city",
    "purchase_location",
    "discount",
    "quantity",
]


class SchemaMismatch(ValueError):
    """A table does not have the columns its contract names."""


def shape(schema: T.StructType) -> list[tuple[str, str]]:
    """Names and types, leaving nullability aside."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def require_schema(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Return ``df`` unchanged, or raise naming the columns that differ."""
    wanted, found = shape(schema), shape(df.schema)
    if wanted != found:
        missing = [c for c in wanted if c not in found]
        extra = [c for c in found if c not in wanted]
        raise SchemaMismatch(
            f"{table}: expected {len(wanted)} columns, found {len(found)}; "
            f"missing {missing}, unexpected {extra}"
            + ("" if missing or extra else "; the column order differs")
        )
    return df
