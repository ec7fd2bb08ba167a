"""The profiling reports: every finding about a table as a named, lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillstar import schemas
from tillstar.operators import catalog as checks
from tillstar.operators import duplicates as dup
from tillstar.operators import profile
from tillstar.plans.star import masked_contacts


def catalog_report(catalog: DataFrame) -> dict[str, DataFrame]:
    ranges = profile.range_rows(catalog, "price")
    return {
        "schema": profile.schema_report(catalog),
        "describe": profile.describe_columns(catalog),
        "nulls": profile.null_profile(catalog),
        "distinct": profile.distinct_profile(catalog),
        "values": profile.value_counts(catalog, catalog.columns),
        "duplicates": dup.full_row_duplicates(catalog),
        "repeated_ids": dup.repeated_keys(catalog, "product_id"),
        "blank_names": profile.blank_rows(catalog, "product_name"),
        "categories": profile.category_distribution(catalog),
        "negative_prices": ranges["negative"],
        "zero_prices": ranges["zero"],
        "price_summary": profile.numeric_summary(catalog, "price"),
        "price_histogram": profile.histogram(catalog, "price"),
    }


def sales_report(sales: DataFrame, catalog: DataFrame) -> dict[str, DataFrame]:
    return {
        "schema": profile.schema_report(sales),
        "describe": profile.describe_columns(sales),
        "nulls": profile.null_profile_pct(sales),
        "price_mismatches": checks.price_mismatch(sales, catalog),
        "catalog_mismatches": checks.catalog_mismatch(sales, catalog),
        "unknown_products": checks.orphans(sales, catalog, "product_id", "product"),
        "distinct": profile.distinct_profile(sales),
        "repeated_transactions": dup.repeated_keys(sales, "transaction_id"),
        "repeat_comparison": dup.compare_repeats(sales, "transaction_id"),
        "conflicting_rows": dup.rows_of_conflicting_keys(sales, "transaction_id"),
        "duplicate_summary": dup.duplicate_summary(sales),
        "customer_id_summary": dup.repeated_key_summary(sales, "customer_id"),
        "customers": profile.customer_pairs(sales),
        "shared_names": dup.shared_names(sales),
        "emails": profile.email_validation(sales),
        "shared_emails": dup.shared_emails(sales),
        "quantities": profile.quantity_profile(sales),
        "quantity_values": profile.quantity_flag_values(sales),
        "date_formats": profile.date_format_profile(sales),
        "date_orders": profile.date_order_profile(sales),
        "date_order_chart": profile.date_order_chart(sales),
        "phones": profile.phone_strict_validation(sales),
        "missing_phones": profile.missing_phones(sales),
        "phone_lengths": profile.phone_length_profile(sales),
        "domains": profile.value_counts(sales, schemas.DOMAIN_COLUMNS),
        "masked_contacts": masked_contacts(sales),
    }
