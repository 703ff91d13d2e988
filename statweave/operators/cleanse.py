"""Typing of a raw table, then rules over the typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cleanse(
    df: DataFrame, spec: Mapping[str, Column], *derived: Mapping[str, Column], keep: Iterable[str] = ()
) -> DataFrame:
    """Apply the rules of ``spec`` (output name -> expression) in a single projection.

    ``derived`` rules see the columns of the steps before them. A rule that needs a typed
    value several times belongs there: written over the text it would parse it each time.
    ``keep`` names columns passed through unchanged where the input has them, so the
    original value can stay beside the treated one.
    """
    passed = [F.col(name) for name in keep if name in df.columns]
    typed = df.select(*[rule.alias(name) for name, rule in spec.items()], *passed)
    for step in derived:
        typed = typed.withColumns(dict(step))
    return typed
