"""Exact group quantiles and rank sums that never sort a whole group in one task.

A group may hold any share of all rows, so neither ``percentile`` (all values of a
group in one buffer) nor a window over the raw rows scales. Here equal values are
first counted together, then the counts are split into bins that keep the order of
the values: one step works across the bins of a group, another inside a single bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bins per natural-log unit: a bin spans about 0.1 % of its values, and a group whose
# values stay below 1e12 has fewer than 29 000 bins.
BINS_PER_UNIT = 1024


def ordered_bin(value: Column) -> Column:
    """Bin number that never decreases as the value grows; works for any sign."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * BINS_PER_UNIT)).cast("int")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join that matches NULL keys, keeping the left copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = equal if condition is None else condition & equal
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])


def _locate(
    bins: DataFrame, keys: Sequence[str], probabilities: Sequence[float], size: str = "_size"
) -> DataFrame:
    """(keys.., _bin, p, total, _rest): the bin holding each wanted rank, and the rank inside it."""
    group = Window.partitionBy(*keys)
    upto = F.sum(size).over(group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.array(*[F.lit(Decimal(str(p))) for p in probabilities])
    return (
        bins.withColumns({"_upto": upto, "total": F.sum(size).over(group)})
        .withColumn("p", F.explode(wanted))
        .withColumn("_rank", F.greatest(F.ceil(F.col("p") * F.col("total")).cast("long"), F.lit(1)))
        .where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col(size)))
        .select(
            *keys, "_bin", F.col("p").cast("double").alias("p"), "total",
            (F.col("_rank") - F.col("_upto") + F.col(size)).alias("_rest"),
        )
    )


def _pick(inside: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """The value at rank ``_rest`` among the counted values of one bin."""
    ordered = Window.partitionBy(*keys, "p").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.withColumn("_cum", F.sum(n).over(ordered))
        .where((F.col("_rest") <= F.col("_cum")) & (F.col("_rest") > F.col("_cum") - F.col(n)))
        .select(*keys, "p", "total", value)
    )


def quantiles_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], n: str = "n"
) -> DataFrame:
    """(keys.., p, total, value): the smallest value whose cumulative count reaches ``ceil(p * total)``.

    ``counts`` holds one row per (keys, value) with its frequency. First the bin that
    holds the wanted rank is found from bin totals, then only that bin is ranked.
    """
    binned = counts.withColumn("_bin", ordered_bin(F.col(value)))
    bins = binned.groupBy(*keys, "_bin").agg(F.sum(n).alias("_size"))
    inside = null_safe_join(binned, _locate(bins, keys, probabilities), [*keys, "_bin"])
    return _pick(inside, keys, value, n)


def cube_cells(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, str], collapsed: Sequence[str] = (), kept: Sequence[str] = ()
) -> DataFrame:
    """Every row once in each cell of the cube over ``keys``: 2 ** len(keys) copies.

    Keys in ``collapsed`` appear as totals only and keys in ``kept`` as members only,
    which halves the copies each time. Adds ``_c_<key>`` (the member, or the total's label) and ``_totals``, a bit mask of
    the keys that are totals, so that a member spelled like the total stays apart.
    """
    df = df.withColumn("_totals", F.lit(0))
    for position, key in enumerate(keys):
        mask = F.col("_totals")
        member = F.struct(F.col(key).alias(f"_c_{key}"), mask.alias("_mask"))
        total = F.struct(F.lit(totals[key]).alias(f"_c_{key}"), (mask + F.lit(1 << position)).alias("_mask"))
        forms = [member] * (key not in collapsed) + [total] * (key not in kept)
        df = df.select("*", F.inline(F.array(*forms))).drop("_totals").withColumnRenamed("_mask", "_totals")
    return df


def cube_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    totals: Mapping[str, str],
    probabilities: Sequence[float],
    n: str = "n",
    collapsed: Sequence[str] = (),
    kept: Sequence[str] = (),
) -> DataFrame:
    """(keys.., p, total, value) for every cell of the cube over ``keys``, exactly.

    Copying every counted value into all its cells would multiply the largest data of
    the job. Only bin totals are copied: they tell which bin each cell needs, and each
    counted value then meets just the cells that asked for its bin.
    """
    cell = [*(f"_c_{key}" for key in keys), "_totals"]
    binned = counts.withColumn("_bin", ordered_bin(F.col(value)))
    bins = binned.groupBy(*keys, "_bin").agg(F.sum(n).alias("_size"))
    cells = cube_cells(bins, keys, totals, collapsed, kept).groupBy(*cell, "_bin").agg(F.sum("_size").alias("_size"))
    members = cube_cells(bins.select(*keys).distinct(), keys, totals, collapsed, kept)
    wanted = null_safe_join(members, _locate(cells, cell, probabilities), cell)
    # Equal values of different members are merged before the ranking: one task then holds at
    # most the distinct values of one bin, however many rows the cell has.
    inside = null_safe_join(binned, wanted, [*keys, "_bin"]).groupBy(*cell, "p", "total", "_rest", value)
    return _pick(inside.agg(F.sum(n).alias(n)), cell, value, n).select(
        *[F.col(f"_c_{key}").alias(key) for key in keys], "p", "total", value
    )


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, keys, value), keys, value, probabilities)


def rank_sums(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n", also: Sequence[str] = ()) -> DataFrame:
    """(keys.., n, soma, soma_posicao, also..): count, sum and twice the sum of rank x value of every group.

    ``also`` names further counts to be added up on the way; rows that have only those carry a
    NULL value and a count of 0.

    Rows with equal values share ``before + (k + 1) / 2`` as their mean rank, which gives the
    same sum as numbering the rows one by one; twice of it is a whole number. With values of a
    whole decimal kind all sums are exact.
    """
    x, k = F.col(value), F.col(n)
    in_bin = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    bins = (
        counts.groupBy(*keys, value).agg(*[F.sum(m).alias(m) for m in (n, *also)]).withColumn("_bin", ordered_bin(x))
        .withColumn("_before", F.sum(n).over(in_bin) - k)
        .groupBy(*keys, "_bin")
        .agg(
            F.sum(n).alias("_size"),
            F.sum(x * k).alias("_sum"),
            F.sum(x * k * (2 * F.col("_before") + k + 1)).alias("_rank_sum"),
            *[F.sum(m).alias(m) for m in also],
        )
    )
    across = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.withColumn("_before", F.sum("_size").over(across) - F.col("_size"))
        .groupBy(*keys)
        .agg(
            F.sum("_size").alias("n"),
            F.sum("_sum").alias("soma"),
            F.sum(2 * F.col("_before") * F.col("_sum") + F.col("_rank_sum")).alias("soma_posicao"),
            *[F.sum(m).alias(m) for m in also],
        )
    )
