"""Checks that must hold before a table is published.

Every check is a line (check, expected, actual, passed) of a DataFrame. The
numbers come from aggregates over stored tables rather than from counters
collected while writing: a task re-run after a lost executor would count its rows
twice in the latter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import schemas
from tillstar.functions import rules
from tillstar.functions.dates import EITHER_ORDER, date_format, date_order, standard_date
from tillstar.operators.duplicates import repeated_keys

SRC = schemas.SOURCE


class GateFailure(RuntimeError):
    """At least one check did not hold; the message has both numbers of each."""


def check(name: Column | str, expected: Column, actual: Column, passed: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        label.alias("check"),
        expected.cast("long").alias("expected"),
        actual.cast("long").alias("actual"),
        passed.alias("passed"),
    )


def equal(name: Column | str, expected: Column, actual: Column) -> Column:
    return check(name, expected, actual, expected == actual)


def not_empty(name: Column | str, actual: Column) -> Column:
    return check(name, F.lit(1), actual, actual > 0)


def lines(df: DataFrame, *checks: Column) -> DataFrame:
    return df.select(F.inline(F.array(*checks)))


def load_gate(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Columns found against the contract, and at least one row."""
    conforms = schemas.shape(df.schema) == schemas.shape(schema)
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return lines(
        counted,
        check(
            f"{table}: columns",
            F.lit(len(schema.fields)),
            F.lit(len(df.columns)),
            F.lit(conforms),
        ),
        not_empty(f"{table}: rows", F.col("n")),
    )


def reconcile_products(catalog: DataFrame, products: DataFrame) -> DataFrame:
    """No catalog row may be lost to the null rules or to a repeat."""
    raw = catalog.agg(F.count(F.lit(1))).scalar()
    counted = products.agg(F.count(F.lit(1)).alias("n")).select("n", raw.alias("raw"))
    return lines(
        counted,
        not_empty("products: rows", F.col("n")),
        equal("products: rows kept", F.col("raw"), F.col("n")),
    )


def unique_key(df: DataFrame, key: str, table: str) -> DataFrame:
    """No two rows may share a key."""
    counted = repeated_keys(df, key).agg(F.count(F.lit(1)).alias("n"))
    return lines(counted, equal(f"{table}: repeated {key}", F.lit(0), F.col("n")))


def _rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def reconcile_union(parts: Mapping[str, DataFrame], stored: DataFrame, table: str) -> DataFrame:
    """Every source contributes, and the stored union holds as many rows as they do.

    ``parts`` are the sources before the union, each counted by itself.
    """
    spark = stored.sparkSession
    names = [f"part_{i}" for i in range(len(parts))]
    counts = [_rows(df).alias(n) for n, df in zip(names, parts.values(), strict=True)]
    counted = spark.range(1).select(*counts, _rows(stored).alias("total"))
    return lines(
        counted,
        *[not_empty(f"{table}: rows of {s}", F.col(n)) for s, n in zip(parts, names, strict=True)],
        equal(f"{table}: union of sources", sum(map(F.col, names), F.lit(0)), F.col("total")),
    )


def reconcile_tagged(
    parts: Mapping[str, DataFrame], stored: DataFrame, published: DataFrame, table: str
) -> DataFrame:
    """``reconcile_union``, and the stored rows against the rows of the published table."""
    both = stored.sparkSession.range(1).select(
        _rows(stored).alias("total"), _rows(published).alias("final")
    )
    arrived = equal(f"{table}: rows published", F.col("total"), F.col("final"))
    return reconcile_union(parts, stored, table).unionByName(lines(both, arrived))


def all_lines_stored(counts: Mapping[str, int], tagged: DataFrame, table: str) -> DataFrame:
    """Rows of each source in a stored table against the lines counted in its text."""
    counted = tagged.agg(
        *[F.count_if(F.col(SRC) == s).alias(f"part_{i}") for i, s in enumerate(counts)]
    )
    stored = [F.col(f"part_{i}") for i in range(len(counts))]
    return lines(
        counted,
        *[not_empty(f"{table}: rows of {s}", F.lit(n)) for s, n in counts.items()],
        *[
            equal(f"{table}: rows of {s} stored", F.lit(n), part)
            for (s, n), part in zip(counts.items(), stored, strict=True)
        ],
    )


def reconcile_rejects(sales: DataFrame) -> DataFrame:
    """Accepted and rejected rows together are the rows read."""
    reason = rules.sales_reject_reason(schemas.SALES_REQUIRED, schemas.SALES_NOT_BLANK)
    usable = rules.not_null(schemas.SALES_REQUIRED) & rules.not_blank(schemas.SALES_NOT_BLANK)
    counted = sales.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(usable).alias("accepted"),
        F.count(reason).alias("rejected"),
    )
    return lines(
        counted,
        equal(
            "sales: accepted and rejected", F.col("rows"), F.col("accepted") + F.col("rejected")
        ),
    )


def nothing_lost(lost: DataFrame) -> DataFrame:
    """One check per source and column of a table of lost values."""
    counted = lost.groupBy(SRC, "column").agg(F.count(F.lit(1)).alias("lost"))
    label = F.concat(F.col(SRC), F.lit(": values lost in "), F.col("column"))
    return lines(counted, equal(label, F.lit(0), F.col("lost")))


def findings(sales: DataFrame) -> DataFrame:
    """Rows the fact leaves out, and rows whose date it cannot read or reads by its fallback."""
    text = F.col("transaction_date")
    reason = rules.sales_reject_reason(schemas.SALES_REQUIRED, schemas.SALES_NOT_BLANK)
    kept = reason.isNull()
    unreadable = standard_date(text).isNull()
    either = (date_format(text) == EITHER_ORDER) & date_order(text).isNull()
    counts = {
        "rejected_rows": F.count(reason),
        "unreadable_dates": F.count_if(kept & unreadable),
        "ambiguous_dates": F.count_if(kept & ~unreadable & either),
    }
    parts = [F.struct(F.lit(k).alias("finding"), n.alias("row_count")) for k, n in counts.items()]
    return sales.agg(F.array(*parts).alias("lines")).select(F.inline("lines"))


def enforce(*checks: DataFrame) -> None:
    """Raise naming every check that failed. A handful of lines reach the driver."""
    failed = []
    for part in checks:
        failed += part.filter(~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if failed:
        raise GateFailure(
            "; ".join(f"{r['check']}: expected {r['expected']}, found {r['actual']}" for r in failed)
        )
