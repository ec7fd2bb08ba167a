"""Profiles: what a table's columns hold, as DataFrames.

Whole-table profiles are computed for all columns in one aggregate and turned
into one line per column afterwards. Value-level profiles are counted map-side
before the shuffle, so a value held by most rows costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions import rules
from tillstar.functions.dates import date_format, date_order
from tillstar.operators.duplicates import as_text
from tillstar.operators.ranks import exact_quantiles

# The quantiles of a price summary, and the accuracy of their sketch.
QUARTILES = [0.25, 0.5, 0.75]
QUANTILE_ACCURACY = 10_000

HISTOGRAM_BINS = 10


def _line_per_column(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate over ``df``, then one output line per entry of ``measures``.

    ``measures`` maps a column name to {output name: aggregate}; every entry has
    the same output names.
    """
    lines = [
        F.struct(F.lit(name).alias("column"), *[agg.alias(out) for out, agg in outputs.items()])
        for name, outputs in measures.items()
    ]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def preview(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """First rows in a fixed order."""
    return df.orderBy(*order).limit(rows)


def lookup(df: DataFrame, key: str, values: list) -> DataFrame:
    """Rows whose key is one of ``values``, ordered by it and then by every other column, so
    the rows of one key can be sorted by several tasks."""
    others = [c for c in df.columns if c != key]
    return df.filter(F.col(key).isin(values)).orderBy(key, *others)


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and known values of every column."""
    return _line_per_column(
        df,
        {
            field.name: {
                "position": F.lit(position),
                "type": F.lit(field.dataType.simpleString()),
                "row_count": F.count(F.lit(1)),
                "non_null_count": F.count(field.name),
            }
            for position, field in enumerate(df.schema.fields, start=1)
        },
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, one wide row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_profile_pct(df: DataFrame) -> DataFrame:
    """Null count and share in percent, one line per column."""
    rows = F.count(F.lit(1))

    def share(nulls: Column) -> Column:
        return F.coalesce(F.when(rows > 0, nulls / rows * 100), F.lit(0.0))

    nulls = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    return _line_per_column(
        df, {c: {"missing_count": n, "missing_pct": share(n)} for c, n in nulls.items()}
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, row_count) for every value of the named columns, null included."""
    return (
        df.select(*[as_text(df, c).alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _typed_lines(df: DataFrame) -> DataFrame:
    """(place, whole, fraction, text): one line per row and column, the value in the part of its
    own type, so that numbers are compared as numbers and never written out as text."""
    kinds = {"whole": "bigint", "fraction": "double", "text": "string"}

    def kind(data_type: T.DataType) -> str:
        if isinstance(data_type, T.IntegralType):
            return "whole"
        return "fraction" if isinstance(data_type, (T.DoubleType, T.FloatType)) else "text"

    cells = []
    for place, field in enumerate(df.schema.fields, start=1):
        own = kind(field.dataType)
        cells.append(F.lit(place))
        cells += [
            (F.col(f"`{field.name}`") if part == own else F.lit(None)).cast(to)
            for part, to in kinds.items()
        ]
    return df.select(F.stack(F.lit(len(df.columns)), *cells).alias("place", *kinds))


def distinct_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column; null counts as one value.

    Exact by default: one shuffle of narrow typed lines, each value of a column only once per
    task. ``approximate`` uses one HyperLogLog++ sketch per column and shuffles nothing but the
    sketches.
    """
    if approximate:
        has_null = {c: F.max(F.col(c).isNull().cast("long")) for c in df.columns}
        return _line_per_column(
            df,
            {
                c: {
                    "distinct_count": F.approx_count_distinct(c)
                    + F.coalesce(has_null[c], F.lit(0).cast("long"))
                }
                for c in df.columns
            },
        )
    counts = _typed_lines(df).distinct().groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(c) for c in df.columns])
    return counts.select(
        F.element_at(names, F.col("place")).alias("column"), F.col("n").alias("distinct_count")
    )


def _is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def describe_columns(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, least and greatest value of every column.

    Least and greatest compare in the column's own type and are shown as text.
    Mean and deviation are null for columns that are not numeric.
    """
    nothing = F.lit(None).cast("double")

    def measures(field: T.StructField) -> dict[str, Column]:
        numeric = _is_numeric(field.dataType)
        return {
            "count": F.count(field.name),
            "mean": F.avg(field.name) if numeric else nothing,
            "stddev": F.stddev(field.name) if numeric else nothing,
            "min": F.min(field.name).cast("string"),
            "max": F.max(field.name).cast("string"),
        }

    return _line_per_column(df, {f.name: measures(f) for f in df.schema.fields})


def _summary(df: DataFrame, column: str, quartiles: list[Column]) -> DataFrame:
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev(column).alias("stddev"),
        F.min(column).alias("min"),
        *[v.alias(f"p{int(q * 100)}") for q, v in zip(QUARTILES, quartiles, strict=True)],
        F.max(column).alias("max"),
    )


def numeric_summary(df: DataFrame, column: str, accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of one column, one row.

    Quartiles are values of the column whose rank is within rows / accuracy of
    the exact one: a mergeable sketch of bounded size, whatever the row count.
    """
    quartiles = F.percentile_approx(column, QUARTILES, accuracy)
    return _summary(df, column, [F.get(quartiles, F.lit(i)) for i in range(len(QUARTILES))])


def exact_summary(
    df: DataFrame, column: str, store: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``numeric_summary`` with exact quartiles, which are looked up at once (see ``ranks``)."""
    kind = df.schema[column].dataType
    found = exact_quantiles(df, column, QUARTILES, store)
    return _summary(df, column, [F.lit(v).cast(kind) for v in found])


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between the least and greatest value, empty bins included.

    A bin holds its lower edge; the last one also holds its upper edge. When all
    values are equal the range is widened by one half on both sides.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    low = bounds.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))).scalar()
    high = bounds.select(F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))).scalar()

    def edge(position: Column | int) -> Column:
        step = (F.col("high") - F.col("low")) / bins
        position = F.lit(position) if isinstance(position, int) else position
        return F.col("low") + position * step

    ranged = values.select("v", low.alias("low"), high.alias("high"))
    passed = sum(((F.col("v") >= edge(i)).cast("int") for i in range(1, bins)), F.lit(0))
    counts = ranged.groupBy((passed + 1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = (
        df.sparkSession.range(1, bins + 1)
        .select(F.col("id").cast("int").alias("bin"), low.alias("low"), high.alias("high"))
        .filter(F.col("low").isNotNull())
    )
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("lower_edge"),
        F.when(F.col("bin") == bins, F.col("high")).otherwise(edge(F.col("bin"))).alias("upper_edge"),
        F.coalesce(F.col("n"), F.lit(0)).alias("row_count"),
    )


def group_count(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Rows per value; null is a group of its own."""
    return df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("row_count"))


def category_distribution(catalog: DataFrame) -> DataFrame:
    """Products per category, largest first."""
    counts = group_count(catalog, F.col("category"), "category")
    return counts.orderBy(F.desc("row_count"), "category")


def blank_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is null or the empty string."""
    return df.filter(rules.is_blank(F.col(column)))


def blank_check(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value, both classes always present."""
    blank = F.count_if(rules.is_blank(F.col(column)))
    return _class_counts(df, "state", {"blank": blank, "filled": F.count(F.lit(1)) - blank})


def range_rows(df: DataFrame, column: str) -> dict[str, DataFrame]:
    """The negative and the zero rows of a column that should be positive."""
    return {
        "negative": df.filter(F.col(column) < 0),
        "zero": df.filter(F.col(column) == 0),
    }


def range_check(df: DataFrame, column: str) -> DataFrame:
    """Rows below, at and above zero and without a value; every class is present."""
    value = F.col(column)
    return _class_counts(
        df,
        "range",
        {
            "negative": F.count_if(value < 0),
            "zero": F.count_if(value == 0),
            "positive": F.count_if(value > 0),
            "missing": F.count_if(value.isNull()),
        },
    )


def _class_counts(df: DataFrame, name: str, classes: dict[str, Column]) -> DataFrame:
    lines = [
        F.struct(F.lit(label).alias(name), count.alias("row_count"))
        for label, count in classes.items()
    ]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def quantity_flag_counts(sales: DataFrame) -> DataFrame:
    return group_count(sales, rules.quantity_flag(F.col("quantity")), "valid_quantity")


def discount_flag_counts(sales: DataFrame) -> DataFrame:
    return group_count(sales, rules.discount_flag(F.col("discount")), "valid_discount")


def quantity_profile(sales: DataFrame) -> DataFrame:
    return group_count(sales, rules.quantity_profile_flag(F.col("quantity")), "valid_quantity")


def quantity_flag_values(sales: DataFrame) -> DataFrame:
    """Every quantity with its profiling flag and row count."""
    flag = rules.quantity_profile_flag(F.col("quantity"))
    return sales.groupBy("quantity", flag.alias("valid_quantity")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def date_format_profile(sales: DataFrame) -> DataFrame:
    return group_count(sales, date_format(F.col("transaction_date")), "date_format")


def date_order_profile(sales: DataFrame) -> DataFrame:
    """Rows per resolved layout; the null line counts the ambiguous and unreadable."""
    return group_count(sales, date_order(F.col("transaction_date")), "date_order")


def date_order_chart(sales: DataFrame) -> DataFrame:
    """``date_order_profile`` without the unresolved rows, largest first."""
    resolved = date_order_profile(sales).filter(F.col("date_order").isNotNull())
    return resolved.orderBy(F.desc("row_count"), "date_order")


def date_format_values(sales: DataFrame) -> DataFrame:
    """Distinct date texts with both layout readings and their rows."""
    text = F.col("transaction_date")
    return (
        sales.groupBy("transaction_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            "transaction_date",
            date_format(text).alias("date_format"),
            date_order(text).alias("date_order"),
            "row_count",
        )
    )


def _validity(df: DataFrame, valid: Column, name: str) -> DataFrame:
    """Rows and share in percent per verdict; both verdicts are always present."""
    rows = F.count(F.lit(1))
    good = F.count_if(valid)

    def line(label: bool, n: Column) -> Column:
        pct = F.coalesce(F.when(rows > 0, n / rows * 100), F.lit(0.0))
        return F.struct(F.lit(label).alias(name), n.alias("row_count"), pct.alias("pct"))

    lines = F.array(line(True, good), line(False, rows - good))
    return df.agg(lines.alias("lines")).select(F.inline("lines"))


def email_validation(sales: DataFrame) -> DataFrame:
    return _validity(sales, rules.email_is_valid(F.col("email")), "email_valid")


def phone_validation(sales: DataFrame) -> DataFrame:
    return _validity(sales, rules.phone_is_valid(F.col("phone")), "phone_valid")


def phone_strict_validation(sales: DataFrame) -> DataFrame:
    return _validity(sales, rules.phone_is_strictly_valid(F.col("phone")), "phone_valid")


def missing_phones(sales: DataFrame) -> DataFrame:
    """Rows whose phone has no text form."""
    text = F.col("phone").cast("string")
    return sales.select("phone", text.alias("phone_str")).filter(F.col("phone_str").isNull())


def phone_length_profile(sales: DataFrame) -> DataFrame:
    return group_count(sales, F.length(F.col("phone").cast("string")), "phone_length")


def customer_pairs(sales: DataFrame) -> DataFrame:
    """Distinct (customer_id, customer_name)."""
    return sales.select("customer_id", "customer_name").distinct()
