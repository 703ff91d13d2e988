"""Overlapping cuts and small helpers shared by the indicator tables."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_whole(df: DataFrame, part: str, whole: str, cut: str = "recorte") -> DataFrame:
    """Each row once under its part and once under the whole, from a single scan."""
    return df.withColumn(cut, F.explode(F.array(F.col(part), F.lit(whole))))


AMOUNT = "decimal(28,8)"  # amounts, weights and counts: eight decimals, 20 digits before them


def amount_sum(value: Column) -> Column:
    """Sum of amounts or weights, added as decimals: exact, and the same for every order of the rows."""
    return F.sum(value.cast(AMOUNT)).cast("double")


def rounded(value: Column, digits: int) -> Column:
    """A value as a decimal, rounded once, half away from zero."""
    return F.round(value.cast(AMOUNT), digits).cast("double")


def ratio(part: Column, whole: Column, digits: int, times: int = 1, kind: str = AMOUNT) -> Column:
    """``times * part / whole`` rounded once, half away from zero; NULL where the whole is zero.

    Both sides are decimals of one ``kind`` and the quotient is a division of whole numbers, so
    no value is rounded before the last step: 0.44999996 with one digit is 0.4.
    """
    p, w = part.cast(kind), whole.cast(kind)
    twice = F.abs(p) * F.lit(Decimal(2 * times * 10**digits)) + F.abs(w)
    units = F.call_function("div", twice, F.nullif(F.abs(w) * F.lit(Decimal(2)), F.lit(Decimal(0))))
    return F.when((p < 0) != (w < 0), -units).otherwise(units).cast("double") / F.lit(float(10**digits))


def money_sum(value: Column) -> Column:
    """Sum of amounts, rounded to cents: added as decimals, so exact and the same for every order of the rows.

    Amounts may have up to eight decimals and 22 digits before them; a larger one is an error.
    """
    return F.round(F.sum(value.cast("decimal(30,8)")), 2).cast("double")


def one_way_profiles(df: DataFrame, dimensions: Sequence[str], measure: str, period: Sequence[str] = ()) -> DataFrame:
    """(period.., dimensao, membro, measure): every dimension by itself, in one pass.

    Grouping sets expand the input, so the rows are first added up over the listed
    dimensions only.
    """
    small = df.groupBy(*period, *dimensions).agg(F.sum(measure).alias(measure))
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimensao"), F.col(d).cast("string").alias("membro")) for d in dimensions]
    )
    return (
        small.select(*period, F.inline(pairs), measure)
        .groupBy(*period, "dimensao", "membro")
        .agg(F.sum(measure).alias(measure))
    )


def with_total(df: DataFrame, measure: str, within: Sequence[str] = (), output: str = "total") -> DataFrame:
    """Total of a measure over aggregated rows, per group or over all of them, on each row.

    The grand total comes from a scalar subquery, which reuses the shuffle of ``df``; an
    unpartitioned window would pull every row into one task.
    """
    if within:
        total = F.sum(measure).over(Window.partitionBy(*within))
    else:
        total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(output, total)


def share_of_total(df: DataFrame, keys: Sequence[str], measure: Column, within: Sequence[str] = ()) -> DataFrame:
    """Sum per key (``parte``) beside the total of those sums (``total``)."""
    parts = df.groupBy(*within, *keys).agg(F.sum(measure).alias("parte"))
    return with_total(parts, "parte", within)
