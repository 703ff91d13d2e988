"""Bands over ages, hours and ratios. Missing values are tested before any comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rulebook as R


def _upper_edges(value: Column, edges: Sequence[tuple[float, str]], above: str) -> list[tuple[Column, Column]]:
    return [(value <= F.lit(edge), F.lit(label)) for edge, label in edges] + [(F.lit(True), F.lit(above))]


def _case(branches: Sequence[tuple[Column, Column]]) -> Column:
    head, *tail = branches
    expr = F.when(*head)
    for condition, result in tail:
        expr = expr.when(condition, result)
    return expr


def age_band(age: Column, bands: Sequence[tuple[int, int, str]] = R.AGE_BANDS) -> Column:
    known = age > 0
    edges = [(bands[0][0] - 1, R.AGE_BELOW)] + [(high, label) for _, high, label in bands]
    return F.when(known, _case(_upper_edges(age, edges, R.AGE_ABOVE)))


def ratio_band(
    ratio: Column,
    missing: str = R.NO_MONTHLY_WAGE,
    edges: Sequence[tuple[float, str]] = R.RATIO_BANDS,
    above: str = R.RATIO_ABOVE,
) -> Column:
    """Band of a value given in references, with inclusive upper edges.

    A missing value and a missing reference both leave the ratio NULL, which has its
    own label instead of falling into the last band.
    """
    return _case([(ratio.isNull(), F.lit(missing)), *_upper_edges(ratio, edges, above)])


def hour_band(
    hours: Column,
    missing: str = R.UNKNOWN_F,
    edges: Sequence[tuple[float, str]] = R.HOUR_BANDS,
    above: str = R.HOUR_ABOVE,
) -> Column:
    absent = hours.isNull() | (hours <= 0)
    return _case([(absent, F.lit(missing)), *_upper_edges(hours, edges, above)])
