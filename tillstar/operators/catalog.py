"""Transactions checked against the product catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.rules import differs
from tillstar.operators.joins import join_dimension

# Catalog attributes that transactions repeat.
SHARED = ["product_name", "category", "price"]


def sales_with_catalog(sales: DataFrame, catalog: DataFrame, small: bool | None = None) -> DataFrame:
    """Inner join on product_id. Catalog attributes carry a ``master_`` prefix."""
    renamed = catalog.select("product_id", *[F.col(c).alias(f"master_{c}") for c in SHARED])
    return join_dimension(sales, renamed, "product_id", "inner", small)


def price_mismatch(sales: DataFrame, catalog: DataFrame, small: bool | None = None) -> DataFrame:
    """Priced rows whose price is not the catalog's."""
    priced = sales.filter(F.col("price").isNotNull())
    return sales_with_catalog(priced, catalog, small).filter(
        F.col("price") != F.col("master_price")
    )


def catalog_mismatch(sales: DataFrame, catalog: DataFrame, small: bool | None = None) -> DataFrame:
    """Rows whose product name or category differs from the catalog's."""
    joined = sales_with_catalog(
        sales.select("transaction_id", "product_id", "product_name", "category", "price"),
        catalog,
        small,
    )
    return joined.select(
        "transaction_id",
        "product_id",
        F.col("product_name").alias("retail_product_name"),
        "master_product_name",
        differs(F.col("product_name"), F.col("master_product_name")).alias("name_check"),
        F.col("category").alias("retail_category"),
        "master_category",
        differs(F.col("category"), F.col("master_category")).alias("category_check"),
    ).filter((F.col("name_check") == "Mismatch") | (F.col("category_check") == "Mismatch"))


def orphans(rows: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """One line: rows of ``rows``, and keys and rows without a dimension entry.

    Both sides are reduced to one line per key before they meet, so no key is
    ever joined with its full weight. A row whose key is null is an orphan.
    """
    used = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dimension.select(key).distinct().withColumn("known", F.lit(True))
    orphan = F.col("known").isNull()
    return used.join(known, key, "left").agg(
        F.lit(name).alias("dimension"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("source_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
    )
