"""Measures that do not add up: Gini index and discounted turnover."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as R
from .cuts import ratio, with_whole
from .quantiles import rank_sums, value_counts


WHOLE = "decimal(31,0)"


def gini_of_counts(counts: DataFrame, keys: Sequence[str], value: str, digits: int = 5) -> DataFrame:
    """Gini index per group: ``2 * sum(rank * x) / (n * sum(x)) - (n + 1) / n``, as one division of whole numbers.

    Values count in cents; the index is rounded once.
    """
    cents = counts.withColumn(value, in_cents(F.col(value)))
    return rank_sums(cents, keys, value).select(*keys, index_of_sums(digits).alias("gini"))


def in_cents(amount: Column) -> Column:
    return F.round(amount.cast("decimal(20,8)") * 100, 0).cast("decimal(18,0)")


def index_of_sums(digits: int) -> Column:
    """The index from the columns of ``rank_sums``."""
    n, total, ranked = F.col("n"), F.col("soma"), F.col("soma_posicao")
    return ratio(ranked - (n + 1) * total, n * total, digits, kind=WHOLE)


def gini(
    silver: DataFrame,
    areas: DataFrame,
    value: str = "remuneracao_media_nominal",
    region: str = R.REGION_NAME,
    digits: int = 5,
) -> DataFrame:
    """Gini of pay for each area and for the whole region, per year."""
    paid = silver.where(F.col("ativo_31_12") & (F.col(value) > 0))
    counts = value_counts(paid, ["ano_base", "municipio_codigo"], value).join(areas, "municipio_codigo")
    cuts = (
        with_whole(counts, "municipio_nome", region)
        .groupBy("ano_base", "recorte", value)
        .agg(F.sum("n").alias("n"))
    )
    return gini_of_counts(cuts, ["ano_base", "recorte"], value, digits)


TURNOVER = ["estoque", "admissoes_rotatividade", "desligamentos_rotatividade"]


def _turnover_counts() -> list[Column]:
    return [
        F.count_if("ativo_31_12").alias("estoque"),
        F.count_if("admissao_rotatividade").alias("admissoes_rotatividade"),
        F.count_if("desligamento_rotatividade").alias("desligamentos_rotatividade"),
    ]


def _turnover() -> Column:
    return ratio(F.least("admissoes_rotatividade", "desligamentos_rotatividade"), F.col("estoque"), 1, 100)


def turnover_rate(silver: DataFrame, areas: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    """Smaller of entries and exits over the stock, per area and for the whole region."""
    counted = (
        silver.groupBy("ano_base", "municipio_codigo")
        .agg(*_turnover_counts())
        .join(areas, "municipio_codigo")
    )
    totals = (
        with_whole(counted, "municipio_nome", region)
        .groupBy("ano_base", "recorte")
        .agg(*[F.sum(m).alias(m) for m in TURNOVER])
    )
    return totals.withColumn("taxa_rotatividade_pct", _turnover())


def inequality_turnover(
    silver: DataFrame, areas: DataFrame, region: str = R.REGION_NAME, value: str = "remuneracao_media_nominal"
) -> DataFrame:
    """Both measures from one look at the contracts: turnover counts ride along with the histogram of pay."""
    keys = ["ano_base", "recorte"]
    pay = F.when(F.col("ativo_31_12") & (F.col(value) > 0), in_cents(F.col(value)))
    counts = silver.withColumn("_pay", pay).groupBy("ano_base", "municipio_codigo", "_pay").agg(F.count("_pay").alias("n"), *_turnover_counts())
    cuts = with_whole(counts.join(areas, "municipio_codigo"), "municipio_nome", region)
    sums = rank_sums(cuts.select(*keys, "_pay", "n", *TURNOVER), keys, "_pay", also=TURNOVER)
    return sums.select(*keys, *TURNOVER, _turnover().alias("taxa_rotatividade_pct"), index_of_sums(3).alias("gini"))
