"""Builds of the published tables: products, customers, sales, calendar, star."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import rules
from tillstar.functions.dates import date_id, standard_date
from tillstar.functions.privacy import mask_email, mask_phone, phone_pseudonym, pseudonym
from tillstar.operators.joins import join_dimension, join_spread

SRC = schemas.SOURCE

# The outcomes of a payment.
STATUSES = ["Successful", "Failed"]
OTHER_STATUS = "other"


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All transaction sources as one DataFrame, every row tagged with its source.

    Later steps then run once over the tagged rows instead of once per source:
    a distinct that includes the tag equals distinct per source, then union all.
    """
    tagged = [df.withColumn(SRC, F.lit(name)) for name, df in sources.items()]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other)
    return result


def clean_products(catalog: DataFrame) -> DataFrame:
    usable = rules.not_null(schemas.PRODUCT_REQUIRED) & ~F.isnan("price")
    return catalog.filter(usable).select(*schemas.CATALOG.names)


def dim_product(catalog: DataFrame) -> DataFrame:
    return clean_products(catalog).distinct()


def _contact_is_valid() -> Column:
    return (
        rules.not_null(schemas.CUSTOMER_REQUIRED)
        & rules.not_blank(schemas.CUSTOMER_NOT_BLANK)
        & rules.email_is_valid(F.col("email"))
        & rules.phone_is_valid(F.col("phone"))
    )


def valid_customers(sales: DataFrame) -> DataFrame:
    """Contact columns of the rows whose contact details are complete and well formed."""
    return sales.filter(_contact_is_valid()).select(*schemas.CUSTOMER_REQUIRED, SRC)


def rejected_contacts(sales: DataFrame) -> DataFrame:
    """The other rows: those that give the customer table nothing."""
    return sales.filter(~F.coalesce(_contact_is_valid(), F.lit(False)))


def hashed(
    customers: DataFrame, secret: str | Column | None = None, normalise_phone: bool = False
) -> DataFrame:
    """Customer columns of contact rows, with the contacts hashed."""
    return customers.select(
        "customer_id",
        "customer_name",
        pseudonym(F.col("email"), secret).alias("email_hash"),
        phone_pseudonym(F.col("phone"), secret, normalise_phone).alias("phone_hash"),
    )


def dim_customer(
    sales: DataFrame, secret: str | Column | None = None, normalise_phone: bool = False
) -> DataFrame:
    """Distinct contacts of each source, one under the other.

    A customer known to two sources appears twice, and an id with two contact
    sets appears once per set; see ``dim_customer_deduped``, ``one_per_customer``.
    """
    return hashed(valid_customers(sales).distinct(), secret, normalise_phone)


def dim_customer_deduped(
    sales: DataFrame, secret: str | Column | None = None, normalise_phone: bool = False
) -> DataFrame:
    """Distinct contacts across all sources."""
    contacts = valid_customers(sales).drop(SRC).distinct()
    return hashed(contacts, secret, normalise_phone)


def one_per_customer(customers: DataFrame) -> DataFrame:
    """One line per customer_id: the least of its contact lines.

    A star join needs this, as a repeated id would repeat the sales rows.
    """
    attributes = [c for c in customers.columns if c != "customer_id"]
    return (
        customers.groupBy("customer_id")
        .agg(F.min(F.struct(*attributes)).alias("least"))
        .select("customer_id", "least.*")
    )


def _usable_sales():
    return rules.not_null(schemas.SALES_REQUIRED) & rules.not_blank(schemas.SALES_NOT_BLANK)


def accepted_sales(sales: DataFrame) -> DataFrame:
    return sales.filter(_usable_sales())


def rejected_sales(sales: DataFrame) -> DataFrame:
    """Rows left out of the fact, with the first rule each breaks."""
    reason = rules.sales_reject_reason(schemas.SALES_REQUIRED, schemas.SALES_NOT_BLANK)
    return sales.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


def distinct_sales(sales: DataFrame) -> DataFrame:
    """Accepted rows without names, prices and contacts; exact repeats within a source collapse."""
    return (
        accepted_sales(sales)
        .select(
            SRC,
            "transaction_id",
            "customer_id",
            "product_id",
            "quantity",
            "city",
            "transaction_date",
            F.col("purchase_location").alias("purchase_mode"),
            "payment_method",
            "discount",
            "payment_status",
        )
        .distinct()
    )


def flagged_sales(rows: DataFrame) -> DataFrame:
    """Fact columns of ``distinct_sales`` rows: flags, real dates, tidy status."""
    return rows.select(
        "transaction_id",
        "customer_id",
        "product_id",
        "quantity",
        rules.quantity_flag(F.col("quantity")).alias("valid_quantity"),
        "city",
        standard_date(F.col("transaction_date")).alias("transaction_date"),
        "purchase_mode",
        "payment_method",
        "discount",
        rules.discount_flag(F.col("discount")).alias("valid_discount"),
        F.initcap("payment_status").alias("payment_status"),
    )


def fact_sales(sales: DataFrame) -> DataFrame:
    return flagged_sales(distinct_sales(sales))


def status_split(fact: DataFrame) -> dict[str, DataFrame]:
    """Successful and failed transactions apart, and any other status in a third part.

    Repeated ids are two outcomes of one sale.
    """
    status = F.col("payment_status")
    parts = {name: fact.filter(status == name) for name in STATUSES}
    known = F.coalesce(status.isin(STATUSES), F.lit(False))
    return parts | {OTHER_STATUS: fact.filter(~known)}


def labelled_split(fact: DataFrame) -> DataFrame:
    """All parts of ``status_split`` in one pass, the part named in ``split``.

    Partitioning a write by ``split`` stores the tables side by side.
    """
    status = F.col("payment_status")
    name = F.when(status.isin(STATUSES), F.lower(status)).otherwise(OTHER_STATUS)
    return fact.withColumn("split", F.concat(name, F.lit("_sales")))


def dim_date(fact: DataFrame) -> DataFrame:
    """Every day from the first to the last transaction date.

    Only the two bounds leave the scan. Four-digit years allow at most 3.7
    million days, so the calendar is bounded whatever the fact holds.
    """
    bounds = fact.agg(
        F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last")
    )
    day = F.col("date")
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        day, *calendar_columns(day)
    )


def calendar_columns(day: Column) -> list[Column]:
    """The calendar attributes of a day, null for no day."""
    return [
        date_id(day).alias("date_id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    ]


def star_enriched(
    fact: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    small_catalog: bool | None = None,
    stored: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every fact row with its product, customer and calendar attributes.

    Outer on the fact side: a sale without a customer line or a readable date
    stays. ``customers`` must hold one line per id and ``products`` one per
    product. Customers grow with the sales, so they are always shuffled, heavy ids
    spread; they come last, as their hashes are wider than a sale, and the ids are
    counted in the fact. Every day of the fact is in its calendar, so the attributes
    follow from the day itself and nothing is joined for them. Where the products are
    shuffled too, ``stored`` may store the sales with their products, so that the shuffles of
    the two joins need not be on disk together.
    """
    priced = join_dimension(fact, products, "product_id", "left", small_catalog)
    if stored and not small_catalog:
        priced = stored(priced)
    known = join_spread(priced, customers, "customer_id", "left", counted=fact, hashed=True)
    keys = ["product_id", "customer_id"]
    columns = [c for df in (fact, customers, products) for c in df.columns if c not in keys]
    return known.select(*keys, *columns, *calendar_columns(F.col("transaction_date")))


def masked_contacts(sales: DataFrame, keep_original: bool = True) -> DataFrame:
    """Contacts with masked forms for display; the originals stay beside them on request."""
    email, phone = F.col("email"), F.col("phone")
    return sales.select(
        "customer_id",
        "customer_name",
        *([email] if keep_original else []),
        mask_email(email).alias("email_masked"),
        *([phone] if keep_original else []),
        mask_phone(phone).alias("phone_masked"),
    )
