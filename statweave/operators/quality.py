"""Named expectations on a table: measured, or measured and dropped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import rulebook as R


def holds(predicate: Column | str) -> Column:
    """True only where the predicate is true: an unknown outcome is a violation."""
    return F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))


def _violations(checks: Mapping[str, Column | str]) -> list[Column]:
    return [F.count_if(~holds(predicate)).alias(name) for name, predicate in checks.items()]


def observe_checks(df: DataFrame, checks: Mapping[str, Column | str], observation: Observation) -> DataFrame:
    """Measure expectations while the rows pass by; no extra scan, no extra job."""
    return df.observe(observation, F.count(F.lit(1)).alias("linhas"), *_violations(checks))


def expect_or_drop(
    df: DataFrame,
    checks: Mapping[str, Column | str],
    observation: Observation | None = None,
) -> DataFrame:
    """Remove rows that break any check. With an observation the breaks are also counted."""
    measured = df if observation is None else observe_checks(df, checks, observation)
    for predicate in checks.values():
        measured = measured.where(holds(predicate))
    return measured


def expect_report(df: DataFrame, checks: Mapping[str, Column | str]) -> DataFrame:
    """(expectativa, linhas, violacoes), all checks counted in one pass."""
    totals = df.agg(F.count(F.lit(1)).alias("linhas"), *_violations(checks))
    entries = F.array(
        *[F.struct(F.lit(name).alias("expectativa"), F.col("linhas"), F.col(name).alias("violacoes")) for name in checks]
    )
    return totals.select(F.inline(entries))


def drop_report(df: DataFrame, checks: Mapping[str, Column | str]) -> DataFrame:
    """(expectativa, linhas, violacoes, so_por_ela): of the rows read, those that break a check, and those that no other check drops."""
    outcome = {name: holds(predicate) for name, predicate in checks.items()}
    broken = sum((F.when(ok, 0).otherwise(1) for ok in outcome.values()), F.lit(0))
    totals = df.withColumn("_broken", broken).agg(
        F.count(F.lit(1)).alias("linhas"),
        *[F.count_if(~ok).alias(f"_v{i}") for i, ok in enumerate(outcome.values())],
        *[F.count_if(~ok & (F.col("_broken") == 1)).alias(f"_o{i}") for i, ok in enumerate(outcome.values())],
    )
    entries = [F.struct(F.lit(name).alias("expectativa"), F.col("linhas"), F.col(f"_v{i}").alias("violacoes"), F.col(f"_o{i}").alias("so_por_ela"))
               for i, name in enumerate(checks)]
    return totals.select(F.inline(F.array(*entries)))


def reliable(sample: Column, minimum: int = R.MIN_SAMPLE) -> Column:
    return sample >= minimum
