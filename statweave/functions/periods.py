"""Month arithmetic on ``yyyymm`` integers, without date parsing per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_year(period: Column) -> Column:
    return F.floor(period / 100).cast("int")


def is_month(period: Column) -> Column:
    return (period - 1) % 100 < 12


def month_index(period: Column) -> Column:
    """Months since year 0; NULL for a month outside 1..12."""
    return F.when(is_month(period), period_year(period) * 12 + period % 100 - 1)


def shift_months(period: Column, months: int) -> Column:
    """The ``yyyymm`` period some months later (or earlier)."""
    index = month_index(period) + months
    return (F.floor(index / 12) * 100 + index % 12 + 1).cast("int")
