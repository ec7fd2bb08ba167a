"""Sales indicators over the star schema.

The formulas are this library's own choice: revenue is quantity times catalog
price, before discount, over rows flagged Valid with the wanted payment status;
orders are distinct transaction ids; the average order value is their quotient.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.joins import join_dimension

DEFAULT_STATUS = "Successful"

# Money is summed exactly: sums of doubles depend on the order of the rows.
MONEY = "decimal(38,4)"


def gross(quantity: Column, price: Column, discount: Column) -> Column:
    """Default amount of a row: the discount is not applied, its unit is unknown."""
    return quantity * price


def priced_sales(
    fact: DataFrame,
    products: DataFrame,
    status: str | None = DEFAULT_STATUS,
    amount: Callable[[Column, Column, Column], Column] = gross,
    small_catalog: bool | None = None,
) -> DataFrame:
    """Countable fact rows with catalog attributes and their amount.

    ``products`` must hold one line per product_id.
    """
    countable = (F.col("valid_quantity") == "Valid") & (F.col("valid_discount") == "Valid")
    if status is not None:
        countable = countable & (F.col("payment_status") == status)
    rows = fact.filter(countable).select(
        "transaction_id", "product_id", "quantity", "discount", "city", "transaction_date"
    )
    worth = amount(F.col("quantity"), F.col("price"), F.col("discount"))
    return join_dimension(rows, products, "product_id", "inner", small_catalog).withColumn(
        "amount", worth.cast(MONEY)
    )


def indicators(priced: DataFrame, *by: Column | str) -> DataFrame:
    """Revenue (to the cent), orders and average order value, overall or per group.

    Amounts are summed as decimals; only the results become doubles, the average from the
    unrounded sum.

    Rows are first summed per group and transaction, map-side and then by both
    keys, so a group with most of the sales is already small and evenly spread
    when the groups are put together.
    """
    names = [f"__by{i}" for i in range(len(by))]
    keyed = priced.select(
        *[(F.col(b) if isinstance(b, str) else b).alias(n) for b, n in zip(by, names)],
        "transaction_id",
        "amount",
    )
    per_order = keyed.groupBy(*names, "transaction_id").agg(F.sum("amount").alias("amount"))
    totals = per_order.groupBy(*names).agg(
        F.sum("amount").alias("total"), F.count("transaction_id").alias("orders")
    )
    average = F.col("total").cast("double") / F.col("orders")
    return totals.select(
        *names,
        F.round("total", 2).cast("double").alias("revenue"),
        "orders",
        F.when(F.col("orders") > 0, average).alias("avg_order_value"),
    )


def _named(df: DataFrame, *names: str) -> DataFrame:
    for i, name in enumerate(names):
        df = df.withColumnRenamed(f"__by{i}", name)
    return df


def kpi_summary(priced: DataFrame) -> DataFrame:
    return indicators(priced)


def kpi_by_product(priced: DataFrame) -> DataFrame:
    return _named(indicators(priced, "product_id", "product_name"), "product_id", "product_name")


def kpi_by_category(priced: DataFrame) -> DataFrame:
    return _named(indicators(priced, "category"), "category")


def kpi_by_city(priced: DataFrame) -> DataFrame:
    return _named(indicators(priced, "city"), "city")


def kpi_by_month(priced: DataFrame) -> DataFrame:
    day = F.col("transaction_date")
    return _named(indicators(priced, F.year(day), F.month(day)), "year", "month")


# Every indicator table, in the order they are published.
TABLES = [kpi_summary, kpi_by_product, kpi_by_category, kpi_by_city, kpi_by_month]
