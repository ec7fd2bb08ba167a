"""Date text: which layout it is in, and the date it stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts the sources mix.
ISO = "yyyy-MM-dd"
DAY_FIRST = "dd-MM-yyyy"
MONTH_FIRST = "MM-dd-yyyy"
EITHER_ORDER = "dd-MM-yyyy or MM-dd-yyyy"

_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
_TWO_TWO_FOUR_SHAPE = r"^\d{2}-\d{2}-\d{4}$"


def _part(text: Column, position: int) -> Column:
    """Number at ``position`` of the dash-separated text, null when it is not one."""
    return F.get(F.split(text, "-"), F.lit(position)).try_cast("int")


def date_format(text: Column) -> Column:
    """Layout by shape alone; null for anything else."""
    return F.when(text.rlike(_ISO_SHAPE), F.lit(ISO)).when(
        text.rlike(_TWO_TWO_FOUR_SHAPE), F.lit(EITHER_ORDER)
    )


def date_order(text: Column) -> Column:
    """Layout with day and month told apart; null where both readings are possible."""
    shape = date_format(text)
    resolved = F.when(_part(text, 0) > 12, F.lit(DAY_FIRST)).when(
        _part(text, 1) > 12, F.lit(MONTH_FIRST)
    )
    return F.when(shape == EITHER_ORDER, resolved).otherwise(shape)


def standard_date(text: Column) -> Column:
    """Publishing rule. The first number picks the layout; month first is the fallback.

    Text that does not parse under the chosen layout becomes null instead of
    ending the job, and is counted by the gates.
    """
    lead = _part(text, 0)
    return (
        F.when(lead > 31, F.try_to_date(text, ISO))
        .when(lead > 12, F.try_to_date(text, DAY_FIRST))
        .otherwise(F.try_to_date(text, MONTH_FIRST))
    )


def date_id(day: Column) -> Column:
    """Sortable integer key of a date: 20240131."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
