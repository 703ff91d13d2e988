"""Landing area of a revisioned feed: which releases are in, which are missing, loading them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .files import write_partitioned
from .literals import literal_table

RELEASE = ["tipo", "competencia"]
RELEASE_SCHEMA = "tipo string, competencia int"
# The on-time file goes last: its folder marks the release as complete.
COMMIT_ORDER = ("FOR", "EXC", "MOV")
STAGING = "_a_publicar"  # scans leave out names that begin with an underscore


def releases(df: DataFrame) -> DataFrame:
    return df.select(*RELEASE).distinct()


def on_time_periods(published: DataFrame) -> DataFrame:
    """Periods whose on-time file is published; the others are not released yet."""
    return published.where(F.col("tipo") == COMMIT_ORDER[-1]).select("competencia").distinct()


def missing_periods(published: DataFrame, landed: DataFrame, floor: int = 0) -> DataFrame:
    """Releases published after the newest complete one that have not landed.

    A release is complete when its on-time file is in; ``floor`` is the starting point
    while nothing is.
    """
    newest = landed.where(F.col("tipo") == COMMIT_ORDER[-1]).agg(F.max("competencia")).scalar()
    released = published.join(on_time_periods(published), "competencia", "left_semi").select(*published.columns)
    later = released.where(F.col("competencia") > F.coalesce(newest, F.lit(floor)))
    return later.join(landed, RELEASE, "left_anti")


def load_summary(published: DataFrame, landed: DataFrame) -> DataFrame:
    """(competencia, tipo, linhas, situacao): what a load would do with every release.

    ``published`` holds raw rows; rows are counted only for releases to be loaded, and a
    period without its on-time file is not loaded yet.
    """
    known = landed.withColumn("_there", F.lit(True))
    on_time = on_time_periods(published).withColumn("_on_time", F.lit(True))
    counted = published.groupBy(*RELEASE).agg(F.count(F.lit(1)).alias("n")).join(known, RELEASE, "left")
    there = F.coalesce("_there", F.lit(False))
    return counted.join(on_time, "competencia", "left").where(there | F.col("_on_time")).select(
        "competencia",
        "tipo",
        F.when(~there, F.col("n")).alias("linhas"),
        F.when(there, "já existia").otherwise("carregado").alias("situacao"),
    )


def new_periods(summary: DataFrame) -> DataFrame:
    """(novas_competencias): how many periods the load brings in."""
    return summary.agg(
        F.count_distinct(F.when(F.col("situacao") == "carregado", F.col("competencia"))).alias("novas_competencias")
    )


def landed_releases(spark: SparkSession, path: str) -> DataFrame | None:
    """Releases found in the landing folder, by its folder names; None while the folder does not exist.

    No file is opened. One row per folder, and the driver lists the folders for any scan of
    them, so the rows become a literal table: a join then knows its size and spares the raw
    rows a shuffle.
    """
    if not store.exists(spark, path):
        return None
    found = [
        (kind.partition("=")[2], int(period.partition("=")[2]))
        for kind in store.children(spark, path) if kind.startswith("tipo=")
        for period in store.children(spark, f"{path}/{kind}") if period.startswith("competencia=")
    ]
    return literal_table(spark, found, RELEASE_SCHEMA)


def pending(published: DataFrame, landed: DataFrame | None, order: Sequence[str] = COMMIT_ORDER) -> DataFrame:
    """(tipo, competencia) of the releases that are not there, in the order in which they are made visible.

    Periods ascend; within a period the on-time file goes last.
    """
    wanted = releases(published).where(F.col("tipo").isin(*order))
    if landed is not None:
        wanted = wanted.join(landed, RELEASE, "left_anti")
    return wanted.orderBy("competencia", F.array_position(F.array(*map(F.lit, order)), F.col("tipo")))


def land(spark: SparkSession, published: DataFrame, path: str, order: Sequence[str] = COMMIT_ORDER, most: int | None = None,
         finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Publish the releases that are not there yet, period by period, the commit marker last; how many.

    All of them are written by one job into a hidden folder, then moved into place one after
    the other. A release is there wholly or not at all, and so is, judged by its marker, a
    period: a run that breaks off after any step leaves the releases before that step, and
    the next run lands exactly the others. ``most`` bounds a run: the first so many are taken.
    ``finish`` makes the rows to land out of ``published``, which may then be narrower.
    """
    staging = f"{path}/{STAGING}"
    store.remove(spark, staging)  # of a run that broke off
    steps = pending(published, landed_releases(spark, path), order)
    steps = [tuple(row) for row in (steps if most is None else steps.limit(most)).toLocalIterator()]  # one row a folder
    if steps:
        chosen = literal_table(spark, steps, RELEASE_SCHEMA)
        write_partitioned(published.join(chosen, RELEASE, "left_semi").select(*published.columns), staging, *RELEASE, finish=finish)
        for kind, period in steps:
            _publish(spark, staging, path, kind, period)
        store.remove(spark, staging)
    return len(steps)


def _publish(spark: SparkSession, staging: str, path: str, kind: str, period: int) -> None:
    folder = f"tipo={kind}/competencia={period}"
    store.move(spark, f"{staging}/{folder}", f"{path}/{folder}")
