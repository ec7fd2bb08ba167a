from __future__ import annotations

import datetime
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from samples import catalog, sales

from tillstar.operators import catalog as checks
from tillstar.operators import profile


def test_nulls(spark, rows):
    df = sales(spark, {"price": None}, {"price": None, "city": None}, {}, {})
    assert profile.null_profile(df).select("price", "city", "email").first() == (2, 1, 0)
    lines = {r["column"]: (r["missing_count"], r["missing_pct"]) for r in profile.null_profile_pct(df).collect()}
    assert len(lines) == 16
    assert lines["price"] == (2, 50.0) and lines["city"] == (1, 25.0) and lines["phone"] == (0, 0.0)


def test_nulls_of_an_empty_table(spark):
    lines = profile.null_profile_pct(sales(spark, {}).limit(0)).collect()
    assert {(r["missing_count"], r["missing_pct"]) for r in lines} == {(0, 0.0)}


def test_distinct_counts_the_missing_value(spark):
    df = sales(spark, {"price": None}, {"price": 1.0}, {"price": 1.0}, {"price": 2.0})
    for approximate in (False, True):
        found = {r["column"]: r["distinct_count"] for r in profile.distinct_profile(df, approximate).collect()}
        assert found["price"] == 3 and found["city"] == 1 and len(found) == 16


def test_schema_report(spark, rows):
    report = profile.schema_report(sales(spark, {"price": None}, {}))
    assert rows(report.filter("column IN ('price', 'phone')")) == [
        ("phone", 15, "string", 2, 2),
        ("price", 5, "double", 2, 1),
    ]


def test_describe(spark):
    df = sales(spark, {"quantity": 1, "city": "B"}, {"quantity": 3, "city": "a"}, {"quantity": None})
    lines = {r["column"]: r for r in profile.describe_columns(df).collect()}
    q = lines["quantity"]
    assert (q["count"], q["mean"], q["min"], q["max"]) == (2, 2.0, "1", "3")
    assert q["stddev"] == pytest.approx(2**0.5)
    c = lines["city"]
    assert (c["count"], c["mean"], c["stddev"], c["min"], c["max"]) == (3, None, None, "B", "a")


def test_numeric_summary(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(None,)], "price double")
    row = profile.numeric_summary(df, "price").first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (100, 50.5, 1.0, 100.0)
    assert (row["p25"], row["p50"], row["p75"]) == (25.0, 50.0, 75.0)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(values=st.lists(st.integers(-50, 50).map(lambda v: v / 4), min_size=1, max_size=40))
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "price double")
    lines = profile.histogram(df, "price").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r["row_count"] for r in lines] == counts.tolist()
    assert [r["lower_edge"] for r in lines] == pytest.approx(edges[:-1].tolist())
    assert lines[-1]["upper_edge"] == pytest.approx(edges[-1])


def test_histogram_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "price double")
    assert profile.histogram(df, "price").collect() == []


def test_blank_and_range_checks(spark, rows):
    df = catalog(
        spark, (1, None, "a", -1.0), (2, "", "a", 0.0), (3, " ", "a", None), (4, "n", "a", 2.0)
    )
    assert rows(profile.blank_rows(df, "product_name"), "product_id") == [(1,), (2,)]
    assert rows(profile.blank_check(df, "product_name")) == [("blank", 2), ("filled", 2)]
    assert rows(profile.range_check(df, "price")) == [
        ("missing", 1),
        ("negative", 1),
        ("positive", 1),
        ("zero", 1),
    ]
    found = profile.range_rows(df, "price")
    assert rows(found["negative"], "product_id") == [(1,)]
    assert rows(found["zero"], "product_id") == [(2,)]


def test_category_distribution_is_ordered(spark):
    df = catalog(spark, (1, "n", "b", 1.0), (2, "n", "a", 1.0), (3, "n", "c", 1.0), (4, "n", "c", 1.0))
    assert [tuple(r) for r in profile.category_distribution(df).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_date_profiles(spark, rows):
    texts = ["2024-01-05", "03-04-2024", "25-01-2024", "01-25-2024", "abc", None]
    df = sales(spark, *[{"transaction_date": t} for t in texts])
    assert rows(profile.date_format_profile(df)) == [
        ("dd-MM-yyyy or MM-dd-yyyy", 3),
        ("yyyy-MM-dd", 1),
        (None, 2),
    ]
    assert rows(profile.date_order_profile(df)) == [
        ("MM-dd-yyyy", 1),
        ("dd-MM-yyyy", 1),
        ("yyyy-MM-dd", 1),
        (None, 3),
    ]
    assert [r["date_order"] for r in profile.date_order_chart(df).collect()] == [
        "MM-dd-yyyy",
        "dd-MM-yyyy",
        "yyyy-MM-dd",
    ]


def test_validity_always_shows_both_verdicts(spark, rows):
    df = sales(spark, {"email": "a@x.com"}, {"email": None}, {"email": "b@x.com"}, {"email": "c@x.com"})
    assert rows(profile.email_validation(df)) == [(False, 1, 25.0), (True, 3, 75.0)]
    assert rows(profile.phone_validation(df)) == [(False, 0, 0.0), (True, 4, 100.0)]
    assert rows(profile.phone_validation(df.limit(0))) == [(False, 0, 0.0), (True, 0, 0.0)]


def test_phones(spark, rows):
    df = sales(spark, {"phone": None}, {"phone": "12"}, {"phone": "(987) 654-3210"})
    assert rows(profile.phone_strict_validation(df), "phone_valid", "row_count") == [(False, 3), (True, 0)]
    assert rows(profile.phone_length_profile(df)) == [(14, 1), (2, 1), (None, 1)]
    assert rows(profile.missing_phones(df)) == [(None, None)]


def test_value_counts(spark, rows):
    df = sales(spark, {"city": None}, {"city": "Oslo"}, {"city": "Oslo", "quantity": 3})
    assert rows(profile.value_counts(df, ["city", "quantity"])) == [
        ("city", "Oslo", 2),
        ("city", None, 1),
        ("quantity", "2", 2),
        ("quantity", "3", 1),
    ]


def test_lookup_and_preview(spark):
    df = sales(spark, *[{"transaction_id": i} for i in (5, 3, 9, 1)])
    assert [r[0] for r in profile.lookup(df, "transaction_id", [9, 3, 4]).collect()] == [3, 9]
    assert [r[0] for r in profile.preview(df, ["transaction_id"], 2).collect()] == [1, 3]


def test_catalog_checks(spark, rows):
    products = catalog(spark, (100, "Pen", "Office", 5.0), (101, "Cup", None, 2.0))
    df = sales(
        spark,
        {"transaction_id": 1},
        {"transaction_id": 2, "product_name": "PEN", "price": 6.0},
        {"transaction_id": 3, "category": "Home", "price": None},
        {"transaction_id": 4, "product_name": None},
        {"transaction_id": 5, "product_id": 101, "product_name": "Cup", "price": 2.0},
        {"transaction_id": 6, "product_id": 999, "price": 1.0},
        {"transaction_id": 7, "product_id": None},
    )
    for small in (True, False, None):
        found = checks.catalog_mismatch(df, products, small)
        assert rows(found, "transaction_id", "name_check", "category_check") == [
            (2, "Mismatch", "Match"),
            (3, "Match", "Mismatch"),
        ]
        assert len(found.columns) == 8
        assert rows(checks.price_mismatch(df, products, small), "transaction_id") == [(2,)]
        assert checks.sales_with_catalog(df, products, small).count() == 5
    assert rows(checks.orphans(df, products, "product_id", "product")) == [("product", 7, 2, 2)]


def test_orphans_with_repeated_dimension_keys(spark, rows):
    products = catalog(spark, (100, "Pen", "Office", 5.0), (100, "Pen", "Office", 6.0))
    df = sales(spark, {}, {}, {"product_id": 5})
    assert rows(checks.orphans(df, products, "product_id", "product")) == [("product", 3, 1, 1)]
    assert rows(checks.orphans(df.limit(0), products, "product_id", "p")) == [("p", 0, 0, 0)]


def test_distinct_values_of_every_type(spark, rows):
    kinds = "`a b` long, f float, d double, t string, y date, k boolean, m decimal(9,2), s short"
    day = datetime.date(2024, 1, 5)
    lines = [
        (1, 0.5, 0.0, "1", day, True, Decimal("1.50"), 1),
        (1, None, -0.0, "01", day, False, Decimal("1.5"), 2),
        (None, 0.5, float("nan"), "", None, None, None, None),
        (1 << 62, 0.25, float("nan"), None, None, None, None, 1),
        ((1 << 62) + 1, 0.25, None, "a", None, None, None, 1),
    ]
    df = spark.createDataFrame(lines, kinds)
    assert rows(profile.distinct_profile(df)) == [
        ("a b", 4), ("d", 3), ("f", 3), ("k", 3), ("m", 2), ("s", 3), ("t", 5), ("y", 2)
    ]
    assert profile.distinct_profile(df.limit(0)).collect() == []
