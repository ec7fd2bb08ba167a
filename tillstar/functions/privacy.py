"""Masking for display and hashing for published tables."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.rules import phone_digits

# Fixed value: what replaces the hidden middle of a value.
STARS = "******"


def mask_email(email: Column) -> Column:
    """First two characters, stars, then everything from the first ``@``."""
    domain = F.regexp_extract(email, "(@.*)", 1)
    return F.concat(F.substring(email, 1, 2), F.lit(STARS), domain)


def mask_phone(phone: Column) -> Column:
    """First two characters, stars, then characters nine and ten."""
    text = phone.cast("string")
    return F.concat(F.substring(text, 1, 2), F.lit(STARS), F.substring(text, 9, 2))


def hidden(secret: str) -> Column:
    """The secret as the value of a scalar subquery over a one-row table: plans, explanations and
    event logs name the table's column and never show its value."""
    table = SparkSession.active().createDataFrame([(secret,)], "secret string")
    return table.agg(F.max("secret")).scalar()


def secret_at(spark: SparkSession, path: str) -> Column:
    """The only line of a text file as a secret, read when a query runs, so that no program text
    or setting holds it. Raises if the file does not have exactly one line that is not empty."""
    lines = spark.read.text(path)
    filled = F.length("value") > 0
    found = lines.agg(F.count(F.lit(1)).alias("all"), F.count_if(filled).alias("filled")).first()
    if (found["all"], found["filled"]) != (1, 1):
        raise ValueError(f"{path}: expected one line with a secret, found {found['all']} lines")
    return lines.agg(F.max("value")).scalar()


def pseudonym(value: Column, secret: str | Column | None = None) -> Column:
    """SHA-256 of the value as stored, lower-case hex; null stays null.

    Pseudonymisation, not anonymisation: ten digits can be enumerated. A
    ``secret`` put before the value makes that enumeration useless to anyone
    who does not hold it. It is a text, which never becomes part of the plan
    (see ``hidden``), or a column such as ``secret_at``.
    """
    text = value.cast("string")
    if secret is None or isinstance(secret, str) and not secret:
        return F.sha2(text, 256)
    key = hidden(secret) if isinstance(secret, str) else secret
    return F.sha2(F.concat(key, text), 256)


def phone_pseudonym(
    phone: Column, secret: str | Column | None = None, normalise: bool = False
) -> Column:
    """Hash of the phone as stored, or of its digits when ``normalise`` is set."""
    return pseudonym(phone_digits(phone) if normalise else phone, secret)
