"""Yearly snapshot: stock facts as sums and counts, regional stock."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rulebook as R
from ..functions import eligible_size, hour_band, major_group, ratio_band, year_lookup
from .cuts import money_sum
from .flow import described

STOCK_KEYS = [
    "ano_base", "municipio_codigo", "municipio_nome", "cnae_secao", "cnae_secao_descricao", "porte_oficial",
    "estatutario", "faixa_etaria", "sexo", "raca_cor", "grau_instrucao_codigo", "escolaridade", "faixa_horas",
    "faixa_renda_sm",
]
STOCK_MEASURES = [
    "vinculos", "soma_rem_dezembro", "n_rem_dezembro", "soma_rem_media", "n_rem_media", "soma_tempo_emprego",
    "n_tempo_emprego", "soma_rem_media_com_horas", "soma_horas_mes",
]
OCCUPATION_KEYS = ["ano_base", "municipio_codigo", "municipio_nome", "cbo_codigo", "cbo_descricao", "grande_grupo"]
OCCUPATION_MEASURES = ["vinculos", "soma_rem_dezembro", "n_rem_dezembro"]

_CODE_OF = {
    "municipio_nome": "municipio_codigo",
    "cnae_secao_descricao": "cnae_secao",
    "escolaridade": "grau_instrucao_codigo",
    "cbo_descricao": "cbo_codigo",
    "grande_grupo": "cbo_codigo",
}


def active_only(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("ativo_31_12"))


def stock_by(
    silver: DataFrame,
    areas: DataFrame,
    codes: DataFrame,
    keys: Sequence[str] = STOCK_KEYS,
    measures: Sequence[str] = STOCK_MEASURES,
    wages: Mapping[int, float] = R.MINIMUM_WAGE,
) -> DataFrame:
    """Additive stock fact: averages are stored as a sum and the count behind it."""
    hours, pay = F.col("horas_contratuais"), F.col("remuneracao_media_nominal")
    timed = hours > 0
    known = {
        "porte_oficial": eligible_size(F.col("elegivel_porte"), F.col("porte")),
        "faixa_etaria": F.coalesce("faixa_etaria", F.lit(R.UNKNOWN_F)),
        "sexo": F.coalesce("sexo", F.lit(R.UNKNOWN_M)),
        "raca_cor": F.coalesce("raca_cor", F.lit(R.UNKNOWN_F)),
        "faixa_horas": hour_band(hours),
        "faixa_renda_sm": ratio_band(F.col("_razao"), missing=R.NO_PAY),
    }
    formulas = {
        "vinculos": F.count(F.lit(1)),
        "soma_rem_dezembro": money_sum(F.col("remuneracao_dezembro_nominal")),
        "n_rem_dezembro": F.count("remuneracao_dezembro_nominal"),
        "soma_rem_media": money_sum(pay),
        "n_rem_media": F.count(pay),
        "soma_tempo_emprego": money_sum(F.col("tempo_emprego_meses")),
        "n_tempo_emprego": F.count("tempo_emprego_meses"),
        "soma_rem_media_com_horas": money_sum(F.when(timed, pay)),
        "soma_horas_mes": F.round(F.sum(F.when(timed & pay.isNotNull(), hours)) * R.WEEKS_PER_MONTH, 3),
    }
    columns = list(dict.fromkeys([_CODE_OF.get(k, k) for k in keys] + ["municipio_codigo"]))
    values = ["remuneracao_dezembro_nominal", "remuneracao_media_nominal", "tempo_emprego_meses", "horas_contratuais"]
    grouped = (
        active_only(silver)
        .withColumn("_razao", F.try_divide(pay, year_lookup(F.col("ano_base"), wages)))
        .select(*[known.get(c, F.col(c)).alias(c) for c in columns], *values)
        .groupBy(*columns)
        .agg(*[formulas[m].alias(m) for m in measures])
        .join(areas, "municipio_codigo")
    )
    if "cnae_secao_descricao" in keys:
        grouped = described(grouped, codes, "secao", "cnae_secao", "cnae_secao_descricao")
    if "escolaridade" in keys:
        grouped = described(grouped, codes, "graudeinstrucao", "grau_instrucao_codigo", "escolaridade").withColumn(
            "escolaridade", F.coalesce("escolaridade", F.lit(R.UNKNOWN_F))
        )
    if "cbo_descricao" in keys:
        grouped = described(grouped, codes, "cbo2002ocupacao", "cbo_codigo", "cbo_descricao").withColumn(
            "cbo_descricao", F.coalesce("cbo_descricao", F.concat(F.lit(R.OCCUPATION_PREFIX), "cbo_codigo"))
        )
    if "grande_grupo" in keys:
        grouped = grouped.withColumn("grande_grupo", major_group(F.col("cbo_codigo")))
    implied = {_CODE_OF.get(k, k) for k in keys}
    if set(columns) - implied or implied - set(keys):
        grouped = grouped.groupBy(*keys).agg(
            *[(F.sum(m) if m.startswith(("n_", "vinc")) else F.round(F.sum(m), 3)).alias(m) for m in measures]
        )
    return grouped.select(*keys, *measures)


def regional_stock(raw: DataFrame, classes: DataFrame) -> DataFrame:
    """Active contracts of the wider region by year, area and activity section.

    ``raw`` needs ano_base, municipio_codigo, ativo_31_12 and cnae_classe only. Classes
    are counted first; the crosswalk then joins one row per class instead of per contract.
    """
    counted = (
        active_only(raw)
        .groupBy("ano_base", "municipio_codigo", "cnae_classe")
        .agg(F.count(F.lit(1)).alias("vinculos_ativos"))
    )
    return (
        counted.join(classes, "cnae_classe", "left")
        .groupBy("ano_base", "municipio_codigo", "cnae_secao")
        .agg(F.sum("vinculos_ativos").alias("vinculos_ativos"))
    )
