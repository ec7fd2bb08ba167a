"""Repeated keys, conflicting repeats, and contacts shared by several customers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.rules import any_of
from tillstar.operators.joins import ROWS_PER_SLICE, keep_matching

# Keeps a DataFrame once, for work that reads it several times.
Store = Callable[[DataFrame], DataFrame]

# Rows of one key that may stand in one list: a few megabytes.
LISTED_ROWS = 10_000


def as_text(df: DataFrame, column: str) -> Column:
    """Text that is equal exactly where the values are equal (-0.0 equals 0.0)."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)
    return value.cast("string")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, null included, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


@dataclass
class Repeats:
    """Repeated keys with their rows, and the rows of the heaviest if the keys are stored."""

    keys: DataFrame
    heaviest: int | None = None


def counted_repeats(df: DataFrame, key: str, store: Store | None = None) -> Repeats:
    """The repeated keys of ``df``, null left out.

    Every use reads ``df`` again to count them, unless ``store`` (see ``sinks.staged``) keeps
    them: then the key column is read once, and one line with the heaviest key comes back.
    """
    keys = repeated_keys(df, key).filter(F.col(key).isNotNull())
    if store is None:
        return Repeats(keys)
    keys = store(keys)
    return Repeats(keys, keys.agg(F.coalesce(F.max("cnt"), F.lit(0))).first()[0])


def rows_of_repeated_keys(
    df: DataFrame, key: str, store: Store | None = None, repeats: Repeats | None = None
) -> DataFrame:
    """Rows whose key repeats: rows of single keys are dropped before anything else is done."""
    repeats = repeats or counted_repeats(df, key, store)
    return keep_matching(df, repeats.keys, key, "cnt", heaviest=repeats.heaviest)


def compare_repeats(df: DataFrame, key: str, store: Store | None = None) -> DataFrame:
    """Per repeated key: its rows, and the distinct known values of every other column.

    Where the heaviest key is known to have few rows, those of each key are listed, and only the
    rows of repeated keys are shuffled, once. Otherwise rows become narrow (key, column, value)
    lines, which are counted map-side first, so a key with a third of all rows is reduced by then.
    """
    found = counted_repeats(df, key, store)
    repeats = rows_of_repeated_keys(df, key, repeats=found).filter(F.col(key).isNotNull())
    others = [c for c in df.columns if c != key]
    if found.heaviest is not None and found.heaviest <= LISTED_ROWS:
        texts = F.struct(*[as_text(df, c).alias(c) for c in others])
        listed = repeats.repartition(key).groupBy(key)
        listed = listed.agg(F.count(F.lit(1)).alias("row_count"), F.collect_list(texts).alias("rows"))
        return listed.select(
            key, "row_count", *[_known_values(c).alias(f"{c}_distinct") for c in others]
        )
    lines = (
        repeats.select(key, *[as_text(repeats, c).alias(c) for c in others])
        .unpivot([key], others, "column", "value")
        .groupBy(key, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def known(column: str) -> Column:
        return (F.col("column") == column) & F.col("value").isNotNull()

    # Every row has one line per column, so the lines of any one column add up to the rows.
    row_count = F.sum(F.when(F.col("column") == others[0], F.col("n")))
    return lines.groupBy(key).agg(
        row_count.alias("row_count"),
        *[F.count_if(known(c)).alias(f"{c}_distinct") for c in others],
    )


def _known_values(column: str) -> Column:
    """How many values other than null the field takes in the list ``rows``."""
    values = F.array_compact(F.transform("rows", lambda r: r[column]))
    return F.size(F.array_distinct(values)).cast("long")


def conflicting_repeats(df: DataFrame, key: str, store: Store | None = None) -> DataFrame:
    """The part of ``compare_repeats`` where some other column takes several values."""
    others = [c for c in df.columns if c != key]
    return compare_repeats(df, key, store).filter(any_of(F.col(f"{c}_distinct") > 1 for c in others))


def conflicting_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of ``conflicting_repeats`` and their rows, without the exact counts.

    A column takes several known values exactly where its smallest and largest
    known values differ, which needs one pass and no distinct counting. Best given
    the rows of repeated keys only; a key with one row never conflicts.
    """
    others = [c for c in df.columns if c != key]
    return _bounds(df, key, others).filter(_differing(others)).select(key, "cnt")


def _bounds(df: DataFrame, key: str, others: list[str], *also: Column) -> DataFrame:
    """Per key its rows, the least and greatest value of every other column, and ``also``."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            *[F.min(c).alias(f"{c}_low") for c in others],
            *[F.max(c).alias(f"{c}_high") for c in others],
            *also,
        )
    )


def _differing(others: list[str]) -> Column:
    return any_of(
        F.coalesce(F.col(f"{c}_low") != F.col(f"{c}_high"), F.lit(False)) for c in others
    )


def rows_of_conflicting_keys(df: DataFrame, key: str, store: Store | None = None) -> DataFrame:
    """Rows whose key conflicts.

    With ``store`` the repeated keys are counted once. Where the heaviest is known to have few
    rows, those of each key are listed beside their bounds, and ``df`` is read once more. Else
    the rows of repeated keys are read twice, for the bounds and for the choice, and stored.
    """
    repeats = counted_repeats(df, key, store)
    rows = rows_of_repeated_keys(df, key, repeats=repeats)
    others = [c for c in df.columns if c != key]
    if repeats.heaviest is not None and repeats.heaviest <= LISTED_ROWS:
        listed = F.collect_list(F.struct(*df.columns)).alias("rows")
        found = _bounds(rows.repartition(key), key, others, listed).filter(_differing(others))
        return found.select(F.inline("rows"))
    rows = store(rows) if store else rows
    # A key that conflicts has no more rows than the heaviest of all repeated ones.
    return keep_matching(rows, conflicting_keys(rows, key), key, "cnt", heaviest=repeats.heaviest)


def shared_values(df: DataFrame, column: str, owner: str, keep: list[str]) -> DataFrame:
    """Distinct ``keep`` rows whose ``column`` value belongs to several owners.

    Rows are reduced to distinct ``keep`` tuples first; several owners means the
    smallest and largest owner differ, so no set of owners is ever gathered.
    """
    tuples = df.filter(F.col(column).isNotNull()).select(*keep).distinct()
    held = (
        tuples.groupBy(column)
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.min(owner).alias("low"),
            F.max(owner).alias("high"),
        )
        .filter(F.col("low") != F.col("high"))
    )
    return keep_matching(tuples, held, column, "cnt")


def shared_names(sales: DataFrame) -> DataFrame:
    """(customer_id, customer_name) of names held by several customers, by name."""
    pairs = shared_values(
        sales, "customer_name", "customer_id", ["customer_id", "customer_name"]
    )
    return pairs.orderBy("customer_name", "customer_id")


def shared_emails(sales: DataFrame) -> DataFrame:
    """Customers and contacts behind an e-mail used by several customers."""
    return shared_values(
        sales, "email", "customer_id", ["customer_id", "customer_name", "email", "phone"]
    )


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, and the rows beyond the first copy; nulls are equal."""
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return distinct.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_rows"),
    )


def _unique_and_duplicate(counts: DataFrame, label: str) -> DataFrame:
    """Two lines with share in percent; an empty table has shares of zero."""
    pairs = F.array(
        F.struct(F.lit("Unique").alias("kind"), F.col("distinct_rows").alias("n")),
        F.struct(F.lit("Duplicate").alias("kind"), F.col("duplicate_rows").alias("n")),
    )
    share = F.when(F.col("total_rows") > 0, F.col("line.n") / F.col("total_rows") * 100)
    return counts.select("total_rows", F.explode(pairs).alias("line")).select(
        F.col("line.kind").alias(label),
        F.col("line.n").alias("row_count"),
        F.coalesce(share, F.lit(0.0)).alias("pct"),
    )


def duplicate_summary(df: DataFrame) -> DataFrame:
    return _unique_and_duplicate(full_row_duplicates(df), "type")


def repeated_key_summary(df: DataFrame, key: str) -> DataFrame:
    """First occurrences of a key against repeats; null counts as one key."""
    return _unique_and_duplicate(full_row_duplicates(df.select(key)), "status")
