"""Registered queries and their independent SQL.

``entry`` builds the sales fact; ``queries`` names one callable per operator over
the retail view of the given tables; ``oracle_sql`` gives the same results in SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from oracle.sql import statements  # noqa: E402
from tillstar import schemas  # noqa: E402
from tillstar.functions import rules  # noqa: E402
from tillstar.functions.dates import standard_date  # noqa: E402
from tillstar.operators import catalog as checks  # noqa: E402
from tillstar.operators import duplicates as dup  # noqa: E402
from tillstar.operators import gates, profile  # noqa: E402
from tillstar.operators.joins import fits_broadcast  # noqa: E402
from tillstar.plans import kpi, star  # noqa: E402
from tillstar.plans.pipeline import PIPELINE_NAME  # noqa: E402
from tillstar.sources import audit, delimited, derived, sinks  # noqa: E402

try:  # the corpus operators and their pipeline may be taken out of the library
    import corpus_pipeline
    from tillstar.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tillstar.llm"):
        raise
    corpus = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
SOURCES = derived.SOURCES


def _shown(df: DataFrame, **digits: int) -> DataFrame:
    """Dates as text, and the named doubles rounded, so both engines print alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        elif field.name in digits:
            column = F.round(column, digits[field.name]).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _on_sales(operator: Callable[[DataFrame], DataFrame], **digits: int):
    return lambda spark, folder: _shown(operator(derived.sales(spark, folder)), **digits)


def _on_tagged(operator: Callable[[DataFrame], DataFrame], **digits: int):
    return lambda spark, folder: _shown(operator(derived.tagged_sales(spark, folder)), **digits)


def _on_catalog(operator: Callable[[DataFrame], DataFrame], **digits: int):
    return lambda spark, folder: _shown(operator(derived.catalog(spark, folder)), **digits)


def _on_both(operator: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, folder: _shown(
        operator(derived.sales(spark, folder), derived.catalog(spark, folder))
    )


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_sales(derived.tagged_sales(spark, folder))


def _on_fact(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, folder: _shown(operator(_fact(spark, folder)))


def _on_priced(operator: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        catalog = derived.catalog(spark, folder)
        priced = kpi.priced_sales(
            _fact(spark, folder), star.dim_product(catalog), small_catalog=fits_broadcast(catalog)
        )
        return _shown(operator(priced))

    return query


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def load_gate(spark: SparkSession, folder: str) -> DataFrame:
    tables = [(s, derived.sales(spark, folder, s), schemas.SALES) for s in SOURCES]
    tables.append(("catalog", derived.catalog(spark, folder), schemas.CATALOG))
    return _stack([gates.load_gate(df, schema, name) for name, df, schema in tables])


def _raw_copy(spark: SparkSession, df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Text of ``df`` after a landing file was written and copied to raw, both compressed."""
    landing = sinks.scratch_path(spark, f"landing-{name}")
    raw = sinks.scratch_path(spark, f"raw-{name}")
    sinks.write_table(df, landing, "csv", compression="gzip")
    delimited.landing_to_raw(spark, landing, raw, schema, compression="gzip")
    return delimited.read_raw(spark, raw, schema)


def _raw_sales(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        s: _raw_copy(spark, derived.sales(spark, folder, s), schemas.SALES, s) for s in SOURCES
    }


def landing_to_raw(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw_sales(spark, folder)
    return star.union_sources({s: delimited.typed(t, schemas.SALES) for s, t in raw.items()})


def landing_to_raw_catalog(spark: SparkSession, folder: str) -> DataFrame:
    text = _raw_copy(spark, derived.catalog(spark, folder), schemas.CATALOG, "catalog")
    return delimited.typed(text, schemas.CATALOG)


def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Values lost in typing a raw copy in which some quantities and prices are words."""
    words = {
        "quantity": F.when(F.col("transaction_id") % 997 == 1, "many").otherwise(
            F.col("quantity").cast("string")
        ),
        "price": F.when(F.col("transaction_id") % 499 == 2, "n/a").otherwise(
            F.col("price").cast("string")
        ),
    }
    sales = derived.sales(spark, folder)
    spoiled = sales.withColumns(words)
    text = _raw_copy(spark, spoiled.select(*sales.columns), schemas.SALES, "spoiled")
    return delimited.contract_violations(text, schemas.SALES)


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.scratch_path(spark, "fact-csv")
    sinks.write_table(_fact(spark, folder), path, "csv")
    return _shown(spark.read.schema(schemas.FACT_SALES).option("header", True).csv(path))


def _passing(df: DataFrame, table: str, condition) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(condition).alias("passing_rows"),
    )


def required_not_null(spark: SparkSession, folder: str) -> DataFrame:
    sales, catalog = derived.sales(spark, folder), derived.catalog(spark, folder)
    return _stack(
        [
            _passing(catalog, "dim_product", rules.not_null(schemas.PRODUCT_REQUIRED)),
            _passing(sales, "dim_customer", rules.not_null(schemas.CUSTOMER_REQUIRED)),
            _passing(sales, "fact_sales", rules.not_null(schemas.SALES_REQUIRED)),
        ]
    )


def required_not_blank(spark: SparkSession, folder: str) -> DataFrame:
    sales = derived.sales(spark, folder)
    return _stack(
        [
            _passing(sales, "dim_customer", rules.not_blank(schemas.CUSTOMER_NOT_BLANK)),
            _passing(sales, "fact_sales", rules.not_blank(schemas.SALES_NOT_BLANK)),
        ]
    )


def _on_repeats(operator: Callable[..., DataFrame]):
    """Operators on repeated transactions: the repeated ids are counted once and stored."""
    return lambda spark, folder: _shown(
        operator(derived.sales(spark, folder), "transaction_id", sinks.staged(spark, "repeats"))
    )


def price_summary(spark: SparkSession, folder: str) -> DataFrame:
    catalog = derived.catalog(spark, folder)
    summary = profile.exact_summary(catalog, "price", sinks.staged(spark, "prices"))
    return _shown(summary, mean=6, stddev=6)


def missing_phones(sales: DataFrame) -> DataFrame:
    missing = profile.missing_phones(sales).agg(F.count(F.lit(1))).scalar()
    return sales.agg(F.count(F.lit(1)).alias("rows_read")).withColumn("missing", missing)


def dup_catalog_keys(catalog: DataFrame) -> DataFrame:
    repeated = dup.repeated_keys(catalog, "product_id").agg(F.count(F.lit(1))).scalar()
    keys = catalog.select("product_id").distinct()
    return keys.agg(F.count(F.lit(1)).alias("keys")).withColumn("repeated_keys", repeated)


def ri_orphans(spark: SparkSession, folder: str) -> DataFrame:
    keys = _fact(spark, folder).select("product_id", "customer_id")
    fact = sinks.staged(spark, "fact-keys")(keys)
    customers = star.dim_customer(derived.tagged_sales(spark, folder))
    return _stack(
        [
            checks.orphans(fact, derived.catalog(spark, folder), "product_id", "product"),
            checks.orphans(fact, customers, "customer_id", "customer"),
        ]
    )


def star_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The star, each step stored: the shuffles of one are off the disk before the next begins."""
    fact = sinks.staged_alone(spark, "fact")(_fact(spark, folder))
    customers = star.one_per_customer(star.dim_customer(derived.tagged_sales(spark, folder)))
    customers = sinks.staged_alone(spark, "customers")(customers)
    catalog = derived.catalog(spark, folder)
    return _shown(
        star.star_enriched(
            fact,
            star.dim_product(catalog),
            customers,
            small_catalog=fits_broadcast(catalog),
            stored=sinks.staged_alone(spark, "priced"),
        )
    )


def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    return star.union_sources({s: derived.sales(spark, folder, s) for s in SOURCES})


def date_standardise(sales: DataFrame) -> DataFrame:
    texts = sales.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("row_count"))
    return texts.withColumn("standard_date", standard_date(F.col("transaction_date")))


def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The gates of a run: rows of each source, of the stored union and of the published table.

    As in a run, the transactions are stored once, without the columns that no gate reads.
    """
    catalog = derived.catalog(spark, folder)
    sales = derived.tagged_sales(spark, folder).drop("product_name", "category", "price")
    tagged = sinks.staged(spark, "tagged")(sales)
    parts = {s: tagged.filter(F.col(schemas.SOURCE) == s) for s in SOURCES}

    def gate(build: Callable, publish: Callable, table: str) -> DataFrame:
        stored = sinks.staged(spark, table)(build(tagged))
        published = sinks.staged(spark, f"published-{table}")(publish(stored))
        return gates.reconcile_tagged(
            {s: build(part) for s, part in parts.items()}, stored, published, table
        )

    products = sinks.staged(spark, "products")(star.dim_product(catalog))
    return _stack(
        [
            gates.reconcile_products(catalog, products),
            gate(lambda t: star.valid_customers(t).distinct(), star.hashed, "customers"),
            gate(star.distinct_sales, star.flagged_sales, "sales"),
            gates.reconcile_rejects(tagged),
        ]
    )


def run_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit line of a run whose status is the outcome of the load gate, read back."""
    passed = load_gate(spark, folder).filter(~F.col("passed")).isEmpty()
    path = sinks.scratch_path(spark, "audit")
    status = audit.SUCCEEDED if passed else audit.FAILED
    audit.append_run(spark, path, PIPELINE_NAME, status, "load-gate")
    return audit.read_runs(spark, path).select("pipeline_name", "status", "run_id")


PREVIEW_ORDER = [
    "transaction_id",
    "payment_status",
    "product_id",
    "customer_id",
    "price",
    "quantity",
    "discount",
    "transaction_date",
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the sales fact of the smallest test scale."""
    return _shown(_fact(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return retail_queries() | _corpus_queries()


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if corpus is None:
        return {}
    return corpus.queries() | {"pipeline": corpus_pipeline.run}


def retail_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # Sources, sinks, load control
        "load_gate": load_gate,
        "landing_to_raw": landing_to_raw,
        "landing_to_raw_catalog": landing_to_raw_catalog,
        "contract_violations": contract_violations,
        "csv_roundtrip": csv_roundtrip,
        "preview_top_n": _on_sales(lambda s: profile.preview(s, PREVIEW_ORDER, 10)),
        "schema_report": _on_sales(profile.schema_report),
        "schema_report_catalog": _on_catalog(profile.schema_report),
        # Filters and predicates
        "required_not_null": required_not_null,
        "required_not_blank": required_not_blank,
        "email_validation": _on_sales(profile.email_validation),
        "phone_validation": _on_sales(profile.phone_validation),
        "phone_strict_validation": _on_sales(profile.phone_strict_validation),
        "missing_phones": _on_sales(missing_phones),
        "blank_product_name": _on_catalog(lambda c: profile.blank_check(c, "product_name")),
        "price_range_check": _on_catalog(lambda c: profile.range_check(c, "price")),
        "lookup_by_ids": _on_sales(
            lambda s: profile.lookup(s, "transaction_id", [202, 277, 1351])
        ),
        # Catalog checks and joins
        "sales_product_join": _on_both(checks.sales_with_catalog),
        "price_mismatch": _on_both(checks.price_mismatch),
        "catalog_mismatch": _on_both(checks.catalog_mismatch),
        "ri_orphans": ri_orphans,
        "star_enriched": star_enriched,
        # Duplicates and shared contacts
        "dup_keys": _on_sales(lambda s: dup.repeated_keys(s, "transaction_id")),
        "dup_catalog_keys": _on_catalog(dup_catalog_keys),
        "dup_rows": _on_repeats(dup.rows_of_repeated_keys),
        "dup_comparison": _on_repeats(dup.compare_repeats),
        "dup_conflicts": _on_repeats(dup.conflicting_repeats),
        "dup_conflict_rows": _on_repeats(dup.rows_of_conflicting_keys),
        "shared_names": _on_sales(dup.shared_names),
        "shared_emails": _on_sales(dup.shared_emails),
        "customer_pairs": _on_sales(profile.customer_pairs),
        "full_row_duplicates": _on_sales(dup.full_row_duplicates),
        "duplicate_summary": _on_sales(dup.duplicate_summary),
        "customer_id_dup_summary": _on_sales(
            lambda s: dup.repeated_key_summary(s, "customer_id")
        ),
        "union_sources": union_sources,
        # Profiles
        "domain_values": _on_sales(lambda s: profile.value_counts(s, schemas.DOMAIN_COLUMNS)),
        "category_distribution": _on_catalog(profile.category_distribution),
        "null_profile": _on_sales(profile.null_profile),
        "null_profile_pct": _on_sales(profile.null_profile_pct),
        "distinct_profile": _on_sales(profile.distinct_profile),
        "distinct_profile_catalog": _on_catalog(profile.distinct_profile),
        "describe_numeric": _on_sales(profile.describe_columns, mean=6, stddev=6),
        "describe_catalog": _on_catalog(profile.describe_columns, mean=6, stddev=6),
        "price_summary": price_summary,
        "price_histogram": _on_catalog(lambda c: profile.histogram(c, "price")),
        "quantity_flag": _on_sales(profile.quantity_flag_counts),
        "quantity_flag_profile": _on_sales(profile.quantity_profile),
        "quantity_flag_values": _on_sales(profile.quantity_flag_values),
        "discount_flag": _on_sales(profile.discount_flag_counts),
        "phone_length_profile": _on_sales(profile.phone_length_profile),
        "date_format_profile": _on_sales(profile.date_format_profile),
        "date_order_profile": _on_sales(profile.date_order_profile),
        "date_order_chart_data": _on_sales(profile.date_order_chart),
        "date_format_values": _on_sales(profile.date_format_values),
        "date_standardise": _on_sales(date_standardise),
        # Privacy
        "mask_pii": _on_sales(star.masked_contacts),
        # Published tables
        "dim_product": _on_catalog(star.dim_product),
        "dim_customer": _on_tagged(star.dim_customer),
        "dim_customer_deduped": _on_tagged(star.dim_customer_deduped),
        "fact_sales": lambda spark, folder: _shown(_fact(spark, folder)),
        "status_split": _on_fact(star.labelled_split),
        "rejected_sales": _on_tagged(star.rejected_sales),
        "run_findings": _on_tagged(gates.findings),
        "dim_date": _on_fact(star.dim_date),
        "reconcile_counts": reconcile_counts,
        "run_audit": run_audit,
        # Indicators
        "kpi_summary": _on_priced(kpi.kpi_summary),
        "kpi_by_category": _on_priced(kpi.kpi_by_category),
        "kpi_by_city": _on_priced(kpi.kpi_by_city),
        "kpi_by_product": _on_priced(kpi.kpi_by_product),
        "kpi_by_month": _on_priced(kpi.kpi_by_month),
    }


def oracle_sql() -> dict[str, str]:
    if corpus is None:
        return statements()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return statements() | corpus.oracle_sql() | pipeline
