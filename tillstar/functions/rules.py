"""Row rules as Columns: nothing here touches a DataFrame or runs a job."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the e-mail form that counts as valid.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# A phone number has this many digits.
PHONE_DIGITS = 10
PHONE_STRICT_PATTERN = r"^\d{10}$"


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def not_null(columns: Iterable[str]) -> Column:
    """Every named column holds a value."""
    return all_of(F.col(c).isNotNull() for c in columns)


def not_blank(columns: Iterable[str]) -> Column:
    """Every named column holds more than spaces (a tab is not a space)."""
    return all_of(F.trim(F.col(c).cast("string")) != "" for c in columns)


def is_blank(column: Column) -> Column:
    """Null or the empty string."""
    return column.isNull() | (column == "")


def first_failure(columns: Iterable[str], failed, prefix: str) -> list[Column]:
    """One ``prefix:column`` label per column, null where the column passes."""
    return [F.when(failed(c), F.lit(f"{prefix}:{c}")) for c in columns]


def sales_reject_reason(required: list[str], filled: list[str]) -> Column:
    """Null for a usable sales row, else the first rule the row breaks."""
    return F.coalesce(
        *first_failure(required, lambda c: F.col(c).isNull(), "null"),
        *first_failure(filled, lambda c: F.trim(F.col(c)) == "", "blank"),
        F.lit(None).cast("string"),
    )


def quantity_flag(quantity: Column) -> Column:
    """Publishing rule: a missing quantity is Invalid."""
    return _non_negative_flag(quantity)


def discount_flag(discount: Column) -> Column:
    return _non_negative_flag(discount)


def _non_negative_flag(value: Column) -> Column:
    return F.when(value >= 0, F.lit("Valid")).otherwise(F.lit("Invalid"))


def quantity_profile_flag(quantity: Column) -> Column:
    """Profiling rule: only a negative quantity is INVALID, a missing one is not."""
    return F.when(quantity < 0, F.lit("INVALID")).otherwise(F.lit("VALID"))


def email_is_valid(email: Column) -> Column:
    """Never null: a missing address is not a valid one."""
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))


def phone_digits(phone: Column) -> Column:
    return F.regexp_replace(phone.cast("string"), r"\D", "")


def phone_is_valid(phone: Column) -> Column:
    """Publishing rule: ten digits once separators are dropped."""
    return F.coalesce(F.length(phone_digits(phone)) == PHONE_DIGITS, F.lit(False))


def phone_is_strictly_valid(phone: Column) -> Column:
    """Profiling rule: ten digits and nothing else."""
    return F.coalesce(phone.cast("string").rlike(PHONE_STRICT_PATTERN), F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """Mismatch only where both sides are known and unequal."""
    return F.when(left != right, F.lit("Mismatch")).otherwise(F.lit("Match"))
