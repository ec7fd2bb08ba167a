"""The retail view: transactions and catalog derived from the order tables.

Faults are placed by key arithmetic, so any engine computes the same rows. The
constants below are fixed values of that view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas

SOURCES = ["retail1", "retail2"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").selectExpr(*_PRODUCT).select(
        "product_id", "product_name", "category", "price"
    )


def _copies(fault: str) -> str:
    """One copy of each row, two of those with the fault."""
    return f"explode(sequence(1, CASE WHEN {fault} THEN 2 ELSE 1 END)) AS copy"


_PRODUCT = [
    "p_partkey AS product_id",
    "CASE WHEN p_partkey % 103 = 1 THEN '' ELSE p_name END AS product_name",
    "p_type AS category",
    """CASE WHEN p_partkey % 83 = 2 THEN NULL
            WHEN p_partkey % 89 = 3 THEN 0.0D
            WHEN p_partkey % 97 = 4 THEN -p_retailprice
            ELSE p_retailprice END AS price""",
    _copies("p_partkey % 107 = 6"),
]


# Column expressions of the view, faults included.
_TRANSACTION = [
    "l_orderkey * 10 + l_linenumber AS transaction_id",
    "CASE WHEN l_orderkey % 503 = 7 THEN NULL ELSE o_custkey END AS customer_id",
    "CASE WHEN o_custkey % 250 = 1 THEN 'Shared Name' ELSE c_name END AS customer_name",
    "CASE WHEN l_orderkey % 601 = 3 THEN l_partkey + 10000000 ELSE l_partkey END AS product_id",
    """CASE WHEN l_orderkey % 13 = 0 THEN NULL
            WHEN l_orderkey % 101 = 0 THEN p_retailprice + 1
            ELSE p_retailprice END AS price""",
    "CASE WHEN l_orderkey % 29 = 0 THEN upper(p_name) ELSE p_name END AS product_name",
    "CASE WHEN l_orderkey % 59 = 3 THEN 'UNKNOWN' ELSE p_type END AS category",
    "CASE WHEN l_orderkey % 3 = 0 THEN 'Online' ELSE 'Offline' END AS purchase_location",
    "CASE WHEN l_orderkey % 211 = 0 THEN '  ' ELSE n_name END AS city",
    """CASE WHEN l_orderkey % 401 = 1 THEN 'unknown'
            WHEN l_orderkey % 409 = 1 THEN NULL
            WHEN l_orderkey % 5 <= 2 THEN date_format(CAST(l_shipdate AS date), 'yyyy-MM-dd')
            WHEN l_orderkey % 5 = 3 THEN date_format(CAST(l_shipdate AS date), 'MM-dd-yyyy')
            ELSE date_format(CAST(l_shipdate AS date), 'dd-MM-yyyy') END AS transaction_date""",
    """CAST(CASE WHEN l_orderkey % 307 = 5 THEN NULL
                 WHEN l_orderkey % 97 = 0 THEN -l_quantity ELSE l_quantity END AS int) AS quantity""",
    "l_returnflag AS payment_method",
    """CAST(CAST(round(l_discount * 100) AS int)
            * CASE WHEN l_orderkey % 89 = 0 THEN -1 ELSE 1 END AS double) AS discount""",
    """CASE WHEN o_custkey % 113 = 5 THEN NULL
            WHEN o_custkey % 127 = 5 THEN ''
            WHEN o_custkey % 41 = 0 THEN concat('user', o_custkey, '.example.com')
            WHEN o_custkey % 300 = 7 THEN 'shared@example.com'
            ELSE concat('user', o_custkey, '@example.com') END AS email""",
    """CAST(CASE WHEN o_custkey % 131 = 5 THEN NULL
                 WHEN o_custkey % 37 = 0 THEN 600000000 + o_custkey
                 ELSE 6000000000 + o_custkey END AS string) AS phone""",
    "CASE WHEN l_linestatus = 'F' THEN 'FAILED' ELSE 'successful' END AS payment_status",
    f"CASE WHEN l_orderkey % 2 = 0 THEN '{SOURCES[0]}' ELSE '{SOURCES[1]}' END AS {schemas.SOURCE}",
    _copies("l_orderkey % 223 = 5"),
]


def tagged_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Both transaction sources with their tag.

    Orders meet their customers first, while there is one narrow row of each. They grow with
    the lines, so both are always shuffled, and the orders of a partition are hashed: no line
    is sorted. The other joins carry no hints: Spark broadcasts a side below its size threshold
    and otherwise shuffles, splitting skewed partitions at run time.
    """
    buyers = (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        .join(_table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .select("o_orderkey", "o_custkey", "c_name", "n_name")
    )
    return (
        _table(spark, folder, "lineitem")
        .join(buyers.hint("shuffle_hash"), F.expr("l_orderkey = o_orderkey"))
        .join(_table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
        .selectExpr(*_TRANSACTION)
        .drop("copy")
    )


def sales(spark: SparkSession, folder: str, source: str | None = None) -> DataFrame:
    """The sixteen transaction columns of both sources, or of one."""
    tagged = tagged_sales(spark, folder)
    if source:
        tagged = tagged.filter(F.col(schemas.SOURCE) == source)
    return tagged.select(*schemas.SALES.names)
