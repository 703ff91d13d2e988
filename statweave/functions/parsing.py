"""Tolerant typing of text columns: bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX_DOUBLE = 1.7976931348623157e308


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _finite(value: Column) -> Column:
    # NaN sorts above every number in Spark, so the range test rejects it too.
    return F.when(value.between(-_MAX_DOUBLE, _MAX_DOUBLE), value)


def integer(c: Column | str) -> Column:
    return F.trim(_col(c)).try_cast("int")


def _double(text: Column) -> Column:
    return _finite(text.try_cast("double"))


def decimal_comma(c: Column | str) -> Column:
    return _double(F.replace(F.trim(_col(c)), F.lit(","), F.lit(".")))


def decimal_point(c: Column | str) -> Column:
    return _double(F.trim(_col(c)))


def positive_or_null(c: Column | str) -> Column:
    """Sources that write zero for "not reported"."""
    value = decimal_point(c)
    return F.when(value > 0, value)
