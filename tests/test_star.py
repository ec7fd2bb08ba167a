from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from samples import catalog, sales, tagged

from tillstar import schemas
from tillstar.plans import kpi, star


def test_products_without_a_value_are_dropped(spark, rows):
    df = catalog(
        spark,
        (1, "a", "c", 1.0),
        (1, "a", "c", 1.0),
        (2, "b", "c", None),
        (3, "b", "c", float("nan")),
        (4, None, "c", 1.0),
        (None, "b", "c", 1.0),
        (5, "b", None, 1.0),
        (6, "", "c", 0.0),
    )
    assert rows(star.dim_product(df)) == [(1, "a", "c", 1.0), (6, "", "c", 0.0)]


def test_a_customer_of_two_sources(spark, rows):
    df = tagged(spark, {"src": "one"}, {"src": "one", "city": "Rome"}, {"src": "two"})
    customers = star.dim_customer(df)
    assert schemas.shape(customers.schema) == schemas.shape(schemas.DIM_CUSTOMER)
    assert customers.count() == 2
    assert star.dim_customer_deduped(df).count() == 1


def test_contacts_that_are_left_out(spark, rows):
    df = tagged(
        spark,
        {"customer_id": 1},
        {"customer_id": 2, "email": "nope"},
        {"customer_id": 3, "phone": "123"},
        {"customer_id": 4, "customer_name": "  "},
        {"customer_id": 5, "customer_name": "\t"},
        {"customer_id": None},
        {"customer_id": 6, "phone": "(987) 654-3210"},
    )
    assert rows(star.dim_customer(df), "customer_id") == [(1,), (5,), (6,)]


def test_hash_options(spark):
    df = tagged(spark, {"phone": "(987) 654-3210"})
    plain = star.dim_customer(df).first()
    digits = star.dim_customer(df, normalise_phone=True).first()
    keyed = star.dim_customer(df, secret="k").first()
    same = star.dim_customer(tagged(spark, {"phone": "9876543210"})).first()
    assert digits["phone_hash"] == same["phone_hash"] != plain["phone_hash"]
    assert keyed["email_hash"] != plain["email_hash"] == digits["email_hash"]


def test_one_line_per_customer(spark, rows):
    df = spark.createDataFrame(
        [(1, "B", "x", "y"), (1, "A", "z", "z"), (2, None, "x", "y"), (2, "C", "x", "y")],
        schemas.DIM_CUSTOMER,
    )
    assert rows(star.one_per_customer(df)) == [(1, "A", "z", "z"), (2, None, "x", "y")]


def test_fact_rows(spark):
    df = tagged(
        spark,
        {"transaction_id": 1, "quantity": -1, "discount": -2.0, "payment_status": "fAILED"},
        {"transaction_id": 2, "transaction_date": "25-01-2024"},
        {"transaction_id": 3, "transaction_date": "03-04-2024"},
        {"transaction_id": 4, "transaction_date": "2024-13-45"},
    )
    fact = star.fact_sales(df)
    assert schemas.shape(fact.schema) == schemas.shape(schemas.FACT_SALES)
    found = {r["transaction_id"]: r for r in fact.collect()}
    first = found[1]
    assert (first["valid_quantity"], first["valid_discount"]) == ("Invalid", "Invalid")
    assert first["payment_status"] == "Failed" and first["purchase_mode"] == "Online"
    assert found[2]["transaction_date"] == date(2024, 1, 25)
    assert found[3]["transaction_date"] == date(2024, 3, 4)
    assert found[4]["transaction_date"] is None


def test_exact_repeats_collapse_within_a_source_only(spark):
    df = tagged(spark, {"src": "one"}, {"src": "one", "price": 9.0}, {"src": "two"})
    assert star.fact_sales(df).count() == 2


def test_reject_reasons(spark, rows):
    df = tagged(
        spark,
        {"transaction_id": 1},
        {"transaction_id": None},
        {"transaction_id": 2, "city": " ", "payment_method": ""},
        {"transaction_id": 3, "quantity": None, "city": " "},
        {"transaction_id": 4, "city": "\t"},
        {"transaction_id": 5, "price": None, "email": None},
    )
    assert rows(star.rejected_sales(df), "transaction_id", "reject_reason") == [
        (2, "blank:city"),
        (3, "null:quantity"),
        (None, "null:transaction_id"),
    ]
    assert rows(star.fact_sales(df), "transaction_id") == [(1,), (4,), (5,)]


MAYBE_TEXT = st.sampled_from([None, "", " ", "\t", "x"])


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "transaction_id": st.sampled_from([None, 1]),
                "quantity": st.sampled_from([None, -1, 0]),
                "city": MAYBE_TEXT,
                "payment_status": MAYBE_TEXT,
                "transaction_date": MAYBE_TEXT,
            }
        ),
        min_size=1,
        max_size=20,
    )
)
def test_accepted_and_rejected_are_all_rows(spark, changes):
    df = tagged(spark, *changes)
    accepted, rejected = star.accepted_sales(df), star.rejected_sales(df)
    assert accepted.count() + rejected.count() == len(changes)
    assert accepted.intersectAll(rejected.drop("reject_reason")).isEmpty()


def test_calendar_is_without_gaps(spark):
    df = tagged(
        spark, {"transaction_date": "2024-02-27"}, {"transaction_date": "03-02-2024"}, {"transaction_date": "abc"}
    )
    days = star.dim_date(star.fact_sales(df)).orderBy("date").collect()
    assert [r["date_id"] for r in days] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert tuple(days[2]) == (date(2024, 2, 29), 20240229, 2024, 2, 29)


def test_calendar_of_nothing(spark):
    fact = star.fact_sales(tagged(spark, {"transaction_date": "abc"}))
    assert star.dim_date(fact).collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_star_keeps_every_sale(spark, small):
    df = tagged(
        spark,
        {"transaction_id": 1},
        {"transaction_id": 2, "product_id": 999},
        {"transaction_id": 3, "customer_id": 11, "email": "nope"},
        {"transaction_id": 4, "transaction_date": "abc"},
        {"transaction_id": 5, "src": "two"},
    )
    fact = star.fact_sales(df)
    products = star.dim_product(catalog(spark, (100, "Pen", "Office", 5.0)))
    customers = star.one_per_customer(star.dim_customer(df))
    found = star.star_enriched(fact, products, customers, small)
    lines = {r["transaction_id"]: r for r in found.collect()}
    assert sorted(lines) == [1, 2, 3, 4, 5]
    assert lines[1]["product_name"] == "Pen" and lines[1]["customer_name"] == "Ann"
    assert lines[1]["date_id"] == 20240105
    assert lines[2]["price"] is None
    assert lines[3]["email_hash"] is None
    assert lines[4]["date_id"] is None


def test_split_by_status(spark, rows):
    df = tagged(
        spark,
        {"transaction_id": 1, "payment_status": "SUCCESSFUL"},
        {"transaction_id": 1, "payment_status": "failed"},
        {"transaction_id": 2, "payment_status": "pending"},
    )
    fact = star.fact_sales(df)
    parts = star.status_split(fact)
    assert rows(parts["Successful"], "transaction_id") == [(1,)]
    assert rows(parts["Failed"], "transaction_id") == [(1,)]
    assert rows(star.labelled_split(fact), "transaction_id", "split") == [
        (1, "failed_sales"),
        (1, "successful_sales"),
        (2, "other_sales"),
    ]


def test_masks_hide_the_contacts(spark):
    shown = star.masked_contacts(sales(spark, {}), keep_original=False)
    assert shown.columns == ["customer_id", "customer_name", "email_masked", "phone_masked"]
    assert tuple(shown.first()) == (10, "Ann", "an******@x.com", "98******10")
    assert "email" in star.masked_contacts(sales(spark, {})).columns


def priced(spark, **options):
    df = tagged(
        spark,
        {"transaction_id": 1, "quantity": 2},
        {"transaction_id": 1, "quantity": 1, "product_id": 101},
        {"transaction_id": 2, "quantity": 4, "city": "Rome", "transaction_date": "2024-02-01"},
        {"transaction_id": 3, "quantity": 7, "payment_status": "FAILED"},
        {"transaction_id": 4, "quantity": -7},
        {"transaction_id": 5, "quantity": 7, "discount": -1.0},
        {"transaction_id": 6, "quantity": 7, "product_id": 999},
    )
    products = catalog(spark, (100, "Pen", "Office", 5.0), (101, "Cup", "Home", 2.0))
    return kpi.priced_sales(star.fact_sales(df), products, **options)


def test_indicators(spark, rows):
    df = priced(spark)
    assert rows(kpi.kpi_summary(df)) == [(32.0, 2, 16.0)]
    assert rows(kpi.kpi_by_category(df)) == [("Home", 2.0, 1, 2.0), ("Office", 30.0, 2, 15.0)]
    assert rows(kpi.kpi_by_city(df)) == [("Oslo", 12.0, 1, 12.0), ("Rome", 20.0, 1, 20.0)]
    assert rows(kpi.kpi_by_month(df)) == [(2024, 1, 12.0, 1, 12.0), (2024, 2, 20.0, 1, 20.0)]
    assert rows(kpi.kpi_by_product(df)) == [(100, "Pen", 30.0, 2, 15.0), (101, "Cup", 2.0, 1, 2.0)]


def test_indicator_options(spark, rows):
    assert rows(kpi.kpi_summary(priced(spark, status=None)), "orders") == [(3,)]
    halved = priced(spark, amount=lambda quantity, price, discount: quantity * price / 2)
    assert rows(kpi.kpi_summary(halved), "revenue") == [(16.0,)]
    assert rows(kpi.kpi_summary(priced(spark).limit(0))) == [(None, 0, None)]
