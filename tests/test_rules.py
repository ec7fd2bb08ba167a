from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstar.functions import dates, privacy, rules


def evaluate(spark, value_type, values, column):
    df = spark.createDataFrame([(v,) for v in values], f"x {value_type}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


DATES = [
    "2024-01-05",
    "01-25-2024",
    "25-01-2024",
    "03-04-2024",
    "2024-13-45",
    "2024-1-5",
    "abc",
    None,
    "",
    "13-13-2024",
    "31-12-2023",
    "2024/01/05",
]


def test_date_order(spark):
    assert evaluate(spark, "string", DATES, dates.date_order) == [
        "yyyy-MM-dd",
        "MM-dd-yyyy",
        "dd-MM-yyyy",
        None,
        "yyyy-MM-dd",
        None,
        None,
        None,
        None,
        "dd-MM-yyyy",
        "dd-MM-yyyy",
        None,
    ]


def test_standard_date(spark):
    assert evaluate(spark, "string", DATES, dates.standard_date) == [
        date(2024, 1, 5),
        date(2024, 1, 25),
        date(2024, 1, 25),
        date(2024, 3, 4),
        None,
        None,
        None,
        None,
        None,
        None,
        date(2023, 12, 31),
        None,
    ]


def test_date_id(spark):
    assert evaluate(spark, "date", [date(2024, 3, 9), None], dates.date_id) == [20240309, None]


def test_email(spark):
    values = ["a.b+c@x-y.co", "no-at.example.com", "a@b.c", " a@b.co", "", None, "a@b.co "]
    assert evaluate(spark, "string", values, rules.email_is_valid) == [True] + [False] * 6


def test_phones(spark):
    values = ["9876543210", "(987) 654-3210", "987654321", None, "0123456789", "98765432101"]
    loose = [True, True, False, False, True, False]
    strict = [True, False, False, False, True, False]
    assert evaluate(spark, "string", values, rules.phone_is_valid) == loose
    assert evaluate(spark, "string", values, rules.phone_is_strictly_valid) == strict


def test_numeric_phone(spark):
    assert evaluate(spark, "long", [9876543210, 98765], rules.phone_is_valid) == [True, False]


def test_flags_differ_on_a_missing_quantity(spark):
    values = [-1, 0, 1, None]
    assert evaluate(spark, "int", values, rules.quantity_flag) == [
        "Invalid",
        "Valid",
        "Valid",
        "Invalid",
    ]
    assert evaluate(spark, "int", values, rules.quantity_profile_flag) == [
        "INVALID",
        "VALID",
        "VALID",
        "VALID",
    ]


def test_discount_flag(spark):
    found = evaluate(spark, "double", [-0.5, -0.0, 0.0, 2.5, None], rules.discount_flag)
    assert found == ["Invalid", "Valid", "Valid", "Valid", "Invalid"]


def test_blanks_are_spaces_only(spark):
    values = ["", " ", "   ", "\t", "x", None]
    not_blank = evaluate(spark, "string", values, lambda c: rules.not_blank(["x"]))
    assert not_blank == [False, False, False, True, True, None]
    assert evaluate(spark, "string", values, rules.is_blank) == [
        True,
        False,
        False,
        False,
        False,
        True,
    ]


def test_differs_calls_a_missing_side_a_match(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None)], "l string, r string")
    found = [r[0] for r in df.select(rules.differs(F.col("l"), F.col("r"))).collect()]
    assert found == ["Match", "Mismatch", "Match", "Match"]


def test_masks(spark):
    emails = ["alice@x.com", "nope", None, "a@b@c.com", "x"]
    assert evaluate(spark, "string", emails, privacy.mask_email) == [
        "al******@x.com",
        "no******",
        None,
        "a@******@b@c.com",
        "x******",
    ]
    phones = ["1234567890", None, "12345"]
    assert evaluate(spark, "string", phones, privacy.mask_phone) == [
        "12******90",
        None,
        "12******",
    ]


def test_pseudonyms(spark):
    plain = evaluate(spark, "string", ["abc", None, ""], privacy.pseudonym)
    assert plain == [
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad",
        None,
        "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
    ]
    keyed = evaluate(spark, "string", ["abc"], lambda c: privacy.pseudonym(c, "s3cret"))
    assert keyed[0] != plain[0] and len(keyed[0]) == 64
    raw, digits = (
        evaluate(spark, "string", ["(987) 654-3210", "9876543210"], f)
        for f in (
            privacy.phone_pseudonym,
            lambda c: privacy.phone_pseudonym(c, normalise=True),
        )
    )
    assert raw[0] != raw[1]
    assert digits[0] == digits[1] == raw[1]


@pytest.mark.parametrize("status, wanted", [("SUCCESSFUL", "Successful"), ("fAILED", "Failed")])
def test_status_is_tidied(spark, status, wanted):
    assert evaluate(spark, "string", [status], F.initcap) == [wanted]
