"""Profiling of raw tables: what is odd, missing or implausible before any rule is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decimal_comma, decimal_point
from .cuts import ratio
from .quality import holds
from .quantiles import quantiles_of_counts


def revision_reach(df: DataFrame, kind: str, month: str, before: str) -> DataFrame:
    """How far back each kind of release reaches: oldest, newest and distinct months."""
    return df.groupBy(kind).agg(
        F.min(month).alias("mes_mais_antigo"),
        F.max(month).alias("mes_mais_recente"),
        F.count_distinct(month).alias("meses_afetados"),
        F.count_if(F.col(month) < before).alias("linhas_antes_da_janela"),
    )


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("linhas"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


def percentile_profile(
    df: DataFrame, keys: Sequence[str], value: Column, probabilities: Mapping[str, float]
) -> DataFrame:
    """(keys.., n, one column per percentile, media): exact percentiles of each group.

    Everything is computed from one table of value counts. Rows without a value are
    counted in ``n`` but weigh nothing in the percentiles.
    """
    counts = df.select(*keys, value.alias("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    weighed = counts.withColumn("_k", F.when(F.col("_v").isNull(), 0).otherwise(F.col("_n")))
    ranked = quantiles_of_counts(weighed, keys, "_v", list(probabilities.values()), n="_k")
    wide = ranked.groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys]).agg(
        *[F.max(F.when(F.col("p") == p, F.col("_v"))).alias(name) for name, p in probabilities.items()]
    )
    base = weighed.groupBy(*keys).agg(F.sum("_n").alias("n"), _mean_of_counts().alias("media"))
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return base.join(wide, same, "left").select(*keys, "n", *probabilities, "media")


def _mean_of_counts() -> Column:
    """Mean of the counted values, rounded once; values of 12 digits or more, as in unread texts, are averaged as doubles."""
    v, k = F.col("_v"), F.col("_k")
    exact = ratio(F.sum(v.try_cast("decimal(20,8)") * k.cast("decimal(16,0)")), F.sum(k), 0, kind="decimal(36,8)")
    plain = F.round(F.try_divide(F.sum(v * k), F.sum(k)), 0)
    return F.when(F.max(F.abs(v)) >= 1e12, plain).otherwise(exact)


def cast_success(df: DataFrame, text: str) -> DataFrame:
    """How many texts convert as they are, and how many after the decimal comma is handled."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(~F.contains(F.col(text), F.lit(",")), decimal_point(text))).alias("convertidos_sem_tratar"),
        F.count(decimal_comma(text)).alias("convertidos_trocando_virgula"),
    )


def extremes_profile(df: DataFrame, value: Column, low: float, high: float) -> DataFrame:
    return df.agg(
        F.count_if(value == 0).alias("zero"),
        F.count_if((value > 0) & (value < low)).alias("abaixo"),
        F.count_if(value > high).alias("acima"),
        F.max(value).alias("maximo"),
    )


def band_profile(df: DataFrame, band: Column, hours: Column, flag: Column) -> DataFrame:
    """Rows, mean hours and flagged rows of each band."""
    return (
        df.select(band.alias("faixa"), hours.alias("_h"), flag.alias("_f"))
        .groupBy("faixa")
        .agg(
            F.count(F.lit(1)).alias("n"),
            ratio(F.sum(F.col("_h").cast("decimal(20,8)")), F.count("_h"), 1).alias("horas_semanais_media"),
            F.count_if("_f").alias("tempo_parcial"),
        )
    )


def rule_impact(df: DataFrame, value: Column, rules: Mapping[str, Column]) -> DataFrame:
    """(regra, n, mediana, media): how a rule changes the result, one row per rule.

    Rows are counted by value and outcomes first; only the counts are copied per rule.
    """
    flags = {f"_r{i}": holds(condition) for i, condition in enumerate(rules.values())}
    valued = df.select(value.alias("_v"), *[flag.alias(f) for f, flag in flags.items()]).where(F.col("_v").isNotNull())
    counted = valued.groupBy("_v", *flags).agg(F.count(F.lit(1)).alias("_n"))
    tagged = F.array(*[F.struct(F.lit(name).alias("regra"), F.col(f).alias("_ok")) for name, f in zip(rules, flags)])
    kept = counted.select("_v", "_n", F.inline(tagged)).where("_ok")
    counts = kept.groupBy("regra", "_v").agg(F.sum("_n").alias("_k"))
    summary = counts.groupBy("regra").agg(F.sum("_k").alias("n"), _mean_of_counts().alias("media"))
    medians = quantiles_of_counts(counts, ["regra"], "_v", [0.5], n="_k").select(
        "regra", F.round("_v", 0).alias("mediana")
    )
    return summary.join(medians, "regra").select("regra", "n", "mediana", "media")


def sentinel_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(o_que, n): rows matching each check, all checks in one pass."""
    totals = df.agg(*[F.count_if(check).alias(f"_c{i}") for i, check in enumerate(checks.values())])
    pairs = [F.struct(F.lit(name).alias("o_que"), F.col(f"_c{i}").alias("n")) for i, name in enumerate(checks)]
    return totals.select(F.inline(F.array(*pairs)))


def code_frequency(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(fonte, codigo, n): how often each source uses each code."""
    counted = None
    for name, (df, column) in sources.items():
        one = df.groupBy(F.col(column).alias("codigo")).count().select(
            F.lit(name).alias("fonte"), "codigo", F.col("count").alias("n")
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


def uninformative_columns(df: DataFrame, columns: Sequence[str], sentinels: Mapping[str, str]) -> DataFrame:
    """(coluna, distintos, pct_sentinela): columns that carry one value or a filler.

    The table is reduced to value counts per column first, so the distinct count works
    on one row per value rather than on every row.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("valor")) for c in columns]
    )
    filler = F.lit(None).cast("string")
    for column, value in sentinels.items():
        filler = F.when(F.col("coluna") == column, F.lit(value)).otherwise(filler)
    counts = df.select(F.inline(pairs)).groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("coluna").agg(
        F.count("valor").alias("distintos"),
        ratio(F.sum(F.when(F.col("valor") == filler, F.col("n")).otherwise(0)), F.sum("n"), 1, 100).alias("pct_sentinela"),
    )


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one distinct value. Min and max decide it without a shuffle."""
    names = list(columns or df.columns)
    row = df.agg(
        *[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in names]
    ).first()
    return [c for c in names if row[c]]


def drop_constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*constant_columns(df, columns))


def reconcile(found: DataFrame, keys: Sequence[str], expected: DataFrame) -> DataFrame:
    """(keys.., linhas, esperado, diferenca) for every partition on either side; ``found`` has ``linhas``."""
    both = found.join(expected, list(keys), "full")
    n, wanted = F.coalesce("linhas", F.lit(0)), F.coalesce("esperado", F.lit(0))
    return both.select(*keys, n.alias("linhas"), wanted.alias("esperado"), (n - wanted).alias("diferenca"))


def reconcile_counts(df: DataFrame, keys: Sequence[str], expected: DataFrame) -> DataFrame:
    """The same for rows that are not counted yet."""
    return reconcile(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")), keys, expected)


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
