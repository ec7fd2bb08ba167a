from __future__ import annotations

import random
from functools import partial

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import sales

from tillstar.operators import duplicates as dup
from tillstar.operators import joins
from tillstar.plans import star
from tillstar.sources import sinks

FEW = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
MAYBE = st.one_of(st.none(), st.integers(0, 2))
LINES = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)), MAYBE, MAYBE), min_size=1, max_size=30
)


def repeats(spark):
    return sales(
        spark,
        {"transaction_id": 1, "payment_status": "FAILED"},
        {"transaction_id": 1, "payment_status": "SUCCESSFUL"},
        {"transaction_id": 2, "price": 5.0},
        {"transaction_id": 2, "price": None},
        {"transaction_id": 3},
        {"transaction_id": 3},
        {"transaction_id": 4},
        {"transaction_id": None},
        {"transaction_id": None},
    )


def test_repeated_keys_show_the_missing_key(spark, rows):
    assert rows(dup.repeated_keys(repeats(spark), "transaction_id")) == [
        (1, 2),
        (2, 2),
        (3, 2),
        (None, 2),
    ]


def test_rows_of_repeated_keys_leave_the_missing_key_out(spark, rows):
    found = dup.rows_of_repeated_keys(repeats(spark), "transaction_id")
    assert rows(found, "transaction_id") == [(1,), (1,), (2,), (2,), (3,), (3,)]


def test_a_known_value_beside_a_missing_one_is_no_conflict(spark, rows):
    df = repeats(spark)
    assert rows(dup.conflicting_repeats(df, "transaction_id"), "transaction_id") == [(1,)]
    assert rows(dup.conflicting_keys(df, "transaction_id")) == [(1, 2)]
    found = dup.rows_of_conflicting_keys(df, "transaction_id")
    assert rows(found, "transaction_id", "payment_status") == [(1, "FAILED"), (1, "SUCCESSFUL")]


def test_comparison_counts_known_values(spark, rows):
    compared = dup.compare_repeats(repeats(spark), "transaction_id")
    assert compared.columns[:3] == ["transaction_id", "row_count", "customer_id_distinct"]
    assert len(compared.columns) == 17
    assert rows(compared, "transaction_id", "row_count", "price_distinct", "payment_status_distinct") == [
        (1, 2, 1, 2),
        (2, 2, 1, 1),
        (3, 2, 1, 1),
    ]


def test_signed_zeros_are_one_value(spark, rows):
    df = sales(spark, {"discount": 0.0}, {"discount": -0.0}, {"discount": float("nan")})
    compared = dup.compare_repeats(df, "transaction_id")
    assert rows(compared, "discount_distinct") == [(2,)]


@FEW
@given(lines=LINES)
def test_bounds_find_what_distinct_counts_find(spark, rows, lines):
    df = spark.createDataFrame(lines, "k long, a long, b long")
    counted = (
        df.groupBy("k")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("a").alias("a"),
            F.count_distinct("b").alias("b"),
        )
        .filter("n > 1 AND k IS NOT NULL")
    )
    assert rows(dup.compare_repeats(df, "k")) == rows(counted)
    conflicts = rows(counted.filter("a > 1 OR b > 1"), "k")
    assert rows(dup.conflicting_keys(df, "k"), "k") == conflicts
    inner = df.join(spark.createDataFrame(conflicts, "k long"), "k")
    assert rows(dup.rows_of_conflicting_keys(df, "k")) == rows(inner)


@pytest.mark.parametrize("listed, per_slice", [(10_000, 1_000_000), (0, 1_000_000), (0, 2)])
def test_stored_counts_change_the_plan_only(spark, rows, monkeypatch, listed, per_slice):
    """Rows of a key in one list, in one task, or spread over slices."""
    monkeypatch.setattr(dup, "LISTED_ROWS", listed)
    monkeypatch.setattr(dup, "ROWS_PER_SLICE", per_slice)
    monkeypatch.setattr(dup, "keep_matching", partial(joins.keep_matching, rows_per_slice=per_slice))
    rng = random.Random(6)
    lines = [(rng.choice([None, *range(12), 7, 7, 7, 7]), rng.choice([None, 0.0, -0.0, 1.5]), "b") for _ in range(90)]
    df = spark.createDataFrame([*lines, lines[0]], "k long, a double, b string").repartition(3)
    kept = []

    def store(part):
        kept.append(sinks.staged(spark, "test")(part))
        return kept[-1]

    for operator in (
        dup.rows_of_repeated_keys,
        dup.compare_repeats,
        dup.conflicting_repeats,
        dup.rows_of_conflicting_keys,
    ):
        assert rows(operator(df, "k", store)) == rows(operator(df, "k"))
        assert rows(operator(df.limit(0), "k", store)) == []
    assert all(part.columns[0] == "k" for part in kept)


@FEW
@given(lines=LINES)
def test_shared_values_equal_the_plain_query(spark, rows, lines):
    df = spark.createDataFrame(lines, "owner long, name long, extra long")
    several = (
        df.groupBy("name").agg(F.count_distinct("owner").alias("n")).filter("n > 1").select("name")
    )
    plain = df.join(several, "name").select("owner", "name", "extra").distinct()
    assert rows(dup.shared_values(df, "name", "owner", ["owner", "name", "extra"])) == rows(plain)


@FEW
@given(lines=LINES)
def test_full_row_counts(spark, rows, lines):
    df = spark.createDataFrame(lines, "a long, b long, c long")
    distinct = len(set(lines))
    assert rows(dup.full_row_duplicates(df)) == [(len(lines), distinct, len(lines) - distinct)]


def test_summaries(spark, rows):
    df = sales(spark, {}, {}, {"customer_id": None}, {"customer_id": None, "quantity": 9})
    assert rows(dup.duplicate_summary(df)) == [("Duplicate", 1, 25.0), ("Unique", 3, 75.0)]
    assert rows(dup.repeated_key_summary(df, "customer_id")) == [
        ("Duplicate", 2, 50.0),
        ("Unique", 2, 50.0),
    ]


def test_summary_of_nothing(spark, rows):
    empty = sales(spark, {}).limit(0)
    assert rows(dup.duplicate_summary(empty)) == [("Duplicate", 0, 0.0), ("Unique", 0, 0.0)]


def test_shared_contacts(spark, rows):
    df = sales(
        spark,
        {"customer_id": 1, "customer_name": "Ann", "email": "a@x.com"},
        {"customer_id": 1, "customer_name": "Ann", "email": "a@x.com"},
        {"customer_id": 2, "customer_name": "Ann", "email": "b@x.com"},
        {"customer_id": 3, "customer_name": "Bob", "email": "b@x.com"},
        {"customer_id": 4, "customer_name": None, "email": None},
        {"customer_id": 5, "customer_name": None, "email": None},
    )
    assert rows(dup.shared_names(df)) == [(1, "Ann"), (2, "Ann")]
    assert rows(dup.shared_emails(df), "customer_id", "email") == [(2, "b@x.com"), (3, "b@x.com")]


@FEW
@given(
    lines=st.lists(
        st.tuples(st.integers(0, 2), st.sampled_from(["one", "two"])), min_size=1, max_size=20
    )
)
def test_a_tagged_distinct_is_distinct_per_source_then_union(spark, rows, lines):
    parts = {
        name: spark.createDataFrame([(v,) for v, s in lines if s == name], "v long")
        for name in ("one", "two")
    }
    together = star.union_sources(parts).distinct().drop("src")
    apart = parts["one"].distinct().unionByName(parts["two"].distinct())
    assert rows(together) == rows(apart)
