"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.contracts import MONEY


def cents(value: Column) -> Column:
    """Round half up to whole cents."""
    return F.round(value, 2).cast(MONEY)


def sum_money(value: Column | str, name: str) -> Column:
    """Exact decimal sum, rounded once at the end."""
    return cents(F.sum(value)).alias(name)


def fraction(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole``; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part, whole), digits)


def month_of(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_index(month: Column | str) -> Column:
    """Months since year 0 of a ``yyyy-MM`` text, for calendar arithmetic."""
    m = F.col(month) if isinstance(month, str) else month
    return F.substring(m, 1, 4).cast("int") * 12 + F.substring(m, 6, 2).cast("int") - 1


def month_text(index: Column) -> Column:
    """Inverse of :func:`month_index`."""
    return F.format_string(
        "%04d-%02d", F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int")
    )
