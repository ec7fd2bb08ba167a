"""The whole run: raw files in, checked star schema out, one audit line per run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions.privacy import secret_at
from tillstar.operators import gates
from tillstar.plans import kpi, star
from tillstar.session import tuned
from tillstar.sources import audit, published
from tillstar.sources.delimited import lost_values, read_raw, typed, unsplit_path
from tillstar.sources.sinks import materialise, remove, scratch_path, size_of, write_table

PIPELINE_NAME = "retail_star"
LOST = "__lost"


@dataclass
class Options:
    """How a run reads, hashes and writes.

    A raw value that does not convert to its type, or a raw line that does not split, is
    always counted and kept in ``lost_values``; ``strict`` ends the run for it. ``secret`` keys
    the hashes of contacts; ``secret_file`` names a text file with it instead, which is read
    when a query runs.
    """

    fmt: str = "parquet"
    multi_line: bool = False
    strict: bool = False
    secret: str | None = field(default=None, repr=False)
    secret_file: str | None = None
    normalise_phone: bool = False
    across_sources: bool = False
    partition_fact_by: list[str] = field(default_factory=list)


@dataclass
class Inputs:
    """Stored typed copies: each source, all of them tagged, the catalog, and what was lost."""

    parts: dict[str, DataFrame]
    sales: DataFrame
    catalog: DataFrame
    lost: DataFrame


def load_sources(
    spark: SparkSession, sources: Mapping[str, str], catalog: str, options: Options, scratch: str
) -> Inputs:
    """Typed transactions and catalog, each parsed from text once and stored.

    Everything afterwards reads the columnar copies, so a step reads only its own columns
    and a lost executor never causes the text to be parsed again. The lines of each source
    are counted in its text before, and the stored rows against them after. A raw copy's lines
    that did not split when it was made are read whole, as from the landing file itself.
    """
    counts: dict[str, int] = {}

    def store(name: str, path: str, schema, folder: str) -> DataFrame:
        text = read_raw(spark, path, schema, multi_line=options.multi_line)
        counts[name] = text.count()
        schemas.require_schema(typed(text, schema), schema, path)
        rows = text.withColumn(LOST, lost_values(schema))
        return materialise(typed(rows, schema, LOST), f"{scratch}/{folder}")

    stored = {
        n: store(n, path, schemas.SALES, f"sales-{i}") for i, (n, path) in enumerate(sources.items())
    }
    products = store("catalog", catalog, schemas.CATALOG, "catalog")
    lost = [
        df.select(F.lit(n).alias(schemas.SOURCE), F.inline(LOST))
        for n, df in [*stored.items(), ("catalog", products)]
    ]
    parts = {n: df.drop(LOST) for n, df in stored.items()}
    tagged = star.union_sources(parts)
    inputs = Inputs(
        {n: star.union_sources({n: df}) for n, df in parts.items()},
        tagged,
        products.drop(LOST),
        reduce(DataFrame.unionByName, lost),
    )
    lines = {n: counts[n] for n in sources}
    gates.enforce(
        *([gates.nothing_lost(inputs.lost)] if options.strict else []),
        gates.load_gate(inputs.catalog, schemas.CATALOG, "catalog"),
        gates.all_lines_stored(lines, tagged, "transactions"),
        gates.reconcile_rejects(tagged),
    )
    return inputs


def publish(
    df: DataFrame, schema, path: str, table: str, expected: int, options: Options, partition_by=None
) -> None:
    """Write a table whose inputs passed their gates, then compare what arrived."""
    schemas.require_schema(df, schema, table)
    write_table(df, path, options.fmt, partition_by)
    reader = df.sparkSession.read.schema(schema)
    reader = reader.option("header", True) if options.fmt == "csv" else reader
    arrived = reader.format(options.fmt).load(path).agg(F.count(F.lit(1)).alias("n"))
    gates.enforce(
        gates.lines(arrived, gates.equal(f"{table}: rows published", F.lit(expected), F.col("n")))
    )


def record_findings(inputs: Inputs, run: str, target: str, run_id: str) -> None:
    """Keep what the tables leave out or read with doubt: rows with reasons, and counts, which
    replace those of an earlier run of this id."""
    rejected = star.rejected_sales(inputs.sales)
    schemas.require_schema(rejected, schemas.REJECTED_SALES, "rejected_sales")
    write_table(rejected, f"{run}/rejected_sales")
    write_table(inputs.lost, f"{run}/lost_values")
    contacts = star.rejected_contacts(inputs.sales).agg(
        F.lit("rejected_contacts").alias("finding"), F.count(F.lit(1)).alias("row_count")
    )
    lost = inputs.lost.groupBy(F.concat(F.lit("lost:"), "column").alias("finding")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    found = gates.findings(inputs.sales).unionByName(contacts).unionByName(lost)
    audit.write_findings(found, f"{target}/run_findings", run_id)


def build_products(inputs: Inputs, run: str, options: Options) -> None:
    products = star.dim_product(inputs.catalog)
    gates.enforce(gates.reconcile_products(inputs.catalog, products))
    expected = inputs.catalog.count()
    publish(products, schemas.DIM_PRODUCT, f"{run}/dim_product", "dim_product", expected, options)


def build_customers(inputs: Inputs, run: str, options: Options, scratch: str) -> None:
    def contacts(sales: DataFrame) -> DataFrame:
        return star.valid_customers(sales).distinct()

    stored = materialise(contacts(inputs.sales), f"{scratch}/customers")
    parts = {n: contacts(df) for n, df in inputs.parts.items()}
    gates.enforce(gates.reconcile_union(parts, stored, "customers"))
    build = star.dim_customer_deduped if options.across_sources else star.dim_customer
    secret = options.secret
    if options.secret_file:
        secret = secret_at(stored.sparkSession, options.secret_file)
    customers = build(stored, secret, options.normalise_phone)
    each = stored.drop(schemas.SOURCE).distinct() if options.across_sources else stored
    publish(
        customers,
        schemas.DIM_CUSTOMER,
        f"{run}/dim_customer",
        "dim_customer",
        each.count(),
        options,
    )


def build_fact(inputs: Inputs, run: str, options: Options, scratch: str) -> None:
    stored = materialise(star.distinct_sales(inputs.sales), f"{scratch}/fact")
    parts = {n: star.distinct_sales(df) for n, df in inputs.parts.items()}
    gates.enforce(gates.reconcile_union(parts, stored, "sales"))
    publish(
        star.flagged_sales(stored),
        schemas.FACT_SALES,
        f"{run}/fact_sales",
        "fact_sales",
        stored.count(),
        options,
        options.partition_fact_by,
    )


STAR = ["dim_product", "dim_customer", "fact_sales"]


def run(
    spark: SparkSession,
    sources: Mapping[str, str],
    catalog: str,
    target: str,
    options: Options | None = None,
    run_id: str | None = None,
) -> str:
    """Build and publish ``dim_product``, ``dim_customer`` and ``fact_sales`` below ``target``.

    Beside them go the rejected rows, the values lost on the way from text, the counts of
    both and of doubtful rows, and the audit lines. All tables are written to a folder of the
    run and checked there; only when every one has passed and the findings are kept does one new
    line of the manifest make them the published ones (see ``published``), which is the last
    step that can fail the run. The audit line is written whatever happens; a failure is raised
    after it. The run's own intermediate tables are deleted at the end, and after a failure its
    folder too; folders of replaced runs go once some newer ones are published.
    """
    options = options or Options()
    run_id = run_id or uuid.uuid4().hex
    status = audit.FAILED
    scratch, folder = scratch_path(spark, run_id), published.new_folder(run_id)
    own = f"{target}/{folder}"
    paths = [*sources.values(), catalog]
    try:
        with tuned(spark, size_of(spark, [*paths, *map(unsplit_path, paths)])):
            inputs = load_sources(spark, sources, catalog, options, scratch)
            build_products(inputs, own, options)
            build_customers(inputs, own, options, scratch)
            build_fact(inputs, own, options, scratch)
            record_findings(inputs, own, target, run_id)
            formats = dict.fromkeys(STAR, options.fmt)
            formats |= dict.fromkeys(["rejected_sales", "lost_values"], "parquet")
            published.publish(spark, target, run_id, folder, formats)
        status = audit.SUCCEEDED
    finally:
        remove(spark, scratch)
        if status == audit.FAILED:
            remove(spark, own)
        audit.append_run(spark, f"{target}/run_audit", PIPELINE_NAME, status, run_id)
    published.clean(spark, target)
    return run_id


def publish_reporting(spark: SparkSession, target: str, options: Options | None = None) -> None:
    """Write the calendar and the sales indicators from the published tables, and publish them
    together.

    A product id with two lines would count its sales twice, so ids must be unique.
    """
    options = options or Options()
    fact = published.read(spark, target, "fact_sales", schemas.FACT_SALES)
    products = published.read(spark, target, "dim_product", schemas.DIM_PRODUCT)
    gates.enforce(gates.unique_key(products, "product_id", "dim_product"))
    run_id = f"reporting-{uuid.uuid4().hex}"
    folder = published.new_folder(run_id)
    priced = kpi.priced_sales(fact, products)
    tables = {"dim_date": star.dim_date(fact)}
    tables |= {build.__name__: build(priced) for build in kpi.TABLES}
    try:
        for name, df in tables.items():
            write_table(df, f"{target}/{folder}/{name}", options.fmt)
    except BaseException:
        remove(spark, f"{target}/{folder}")
        raise
    published.publish(spark, target, run_id, folder, dict.fromkeys(tables, options.fmt))
