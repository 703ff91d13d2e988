"""Weighted sample: additive components, and rates computed from them for every cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as R
from ..functions import group_members, simple_case
from .cuts import amount_sum, ratio, rounded, with_whole
from .quality import reliable

COMPONENT_KEYS = ["ano", "trimestre", "area", "sexo", "faixa_etaria", "raca_grupo"]
COUNTS = ["pessoas_amostra", "desocupados_amostra"]
WEIGHT_SUMS = [
    "populacao", "idade_trabalhar", "forca_trabalho", "ocupados", "desocupados", "informais", "conta_propria",
    "contribuintes_previdencia", "subocupados", "forca_potencial", "desalentados",
]
INCOME_SUMS = [
    "soma_renda", "peso_renda", "soma_renda_real", "peso_renda_real", "soma_renda_informal", "peso_renda_informal",
    "soma_renda_formal", "peso_renda_formal",
]
RATE_KEYS = ["recorte", "ano", "trimestre", "sexo", "publico"]


def area_label(core: Column) -> Column:
    return F.when(core, R.CORE_AREA).otherwise(R.OTHER_AREAS)


def race_group(label: Column) -> Column:
    return group_members(label, {R.RACE_WHITE: [R.RACE_WHITE], R.RACE_BLACK: R.RACE_BLACK_MEMBERS}, R.RACE_OTHER)


def _weighted(condition: Column | None = None, value: Column | None = None) -> Column:
    amount = F.col("peso") if value is None else value * F.col("peso")
    return amount_sum(amount if condition is None else F.when(condition, amount))


def _formulas() -> dict[str, Column]:
    employed = F.col("condicao_ocupacao") == 1
    informal = F.coalesce("informal", F.lit(False))
    income = F.col("rendimento_habitual")
    paid = income.isNotNull()
    return {
        "populacao": _weighted(),
        "idade_trabalhar": _weighted(F.col("idade") >= R.WORKING_AGE),
        "forca_trabalho": _weighted(F.col("condicao_forca_trabalho") == 1),
        "ocupados": _weighted(employed),
        "desocupados": _weighted(F.col("condicao_ocupacao") == 2),
        "informais": _weighted(informal),
        "conta_propria": _weighted(employed & (F.col("posicao_ocupacao_codigo") == R.OWN_ACCOUNT)),
        "contribuintes_previdencia": _weighted(F.col("contribui_previdencia")),
        "subocupados": _weighted(F.col("subocupado")),
        "forca_potencial": _weighted(F.col("forca_trabalho_potencial") == 1),
        "desalentados": _weighted(F.col("desalentado")),
        "soma_renda": _weighted(employed, income),
        "peso_renda": _weighted(employed & paid),
        "soma_renda_informal": _weighted(employed & informal, income),
        "peso_renda_informal": _weighted(employed & informal & paid),
        "soma_renda_formal": _weighted(employed & ~informal, income),
        "peso_renda_formal": _weighted(employed & ~informal & paid),
    }


def weighted_components(
    silver: DataFrame, deflators: DataFrame, keys: Sequence[str] = COMPONENT_KEYS
) -> DataFrame:
    """Sums of weights per group. Any rate of any group is a ratio of sums of these.

    A deflator is constant within a quarter, so it multiplies the group sums after the
    aggregation. Income of a quarter without a deflator stays out of both the real sum
    and the weight under it.
    """
    grain = list(dict.fromkeys([*keys, "ano", "trimestre"]))
    labelled = silver.withColumns(
        {
            "area": area_label(F.col("mora_em_fortaleza")),
            "sexo": F.coalesce("sexo", F.lit(R.UNKNOWN_M)),
            "faixa_etaria": F.coalesce("faixa_etaria", F.lit(R.UNKNOWN_F)),
            "raca_grupo": race_group(F.col("raca_cor")),
        }
    )
    sums = labelled.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("pessoas_amostra"),
        F.count_if(F.col("condicao_ocupacao") == 2).alias("desocupados_amostra"),
        *[formula.alias(name) for name, formula in _formulas().items()],
    )
    factor = F.col("deflator_habitual")
    deflated = sums.join(
        deflators.select("ano", "trimestre", "deflator_habitual"), ["ano", "trimestre"], "left"
    ).withColumns(
        {
            "soma_renda_real": F.col("soma_renda") * factor,
            "peso_renda_real": F.when(factor.isNotNull(), F.col("peso_renda")),
        }
    )
    if set(grain) != set(keys):
        return rollup_components(deflated, keys)
    return deflated.select(*keys, *COUNTS, *WEIGHT_SUMS, *INCOME_SUMS)


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in COUNTS] + [amount_sum(F.col(name)).alias(name) for name in [*WEIGHT_SUMS, *INCOME_SUMS]]


def rollup_components(components: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same components at coarser keys, from the stored ones: no second look at the sample."""
    return components.groupBy(*keys).agg(*_sums())


def overlapping_cuts(components: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    """Every component row once under its area and once under the region, area included."""
    return with_whole(components, "area", region)


def _mean_where(condition: Column) -> Column:
    """Weighted mean of the income of one group; the condition may test a grouping column."""
    return F.try_divide(
        amount_sum(F.when(condition, F.col("soma_renda"))), amount_sum(F.when(condition, F.col("peso_renda")))
    )


def group_means(cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean income of women, men and race groups at the given keys."""
    return cuts.groupBy(*keys).agg(*_group_means())


def _group_means() -> list[Column]:
    return [
        _mean_where(F.col("sexo_original") == "Homem").alias("renda_homem"),
        _mean_where(F.col("sexo_original") == "Mulher").alias("renda_mulher"),
        _mean_where(F.col("raca_grupo") == R.RACE_WHITE).alias("renda_branca"),
        _mean_where(F.col("raca_grupo") == R.RACE_BLACK).alias("renda_negra"),
    ]


def _cube_of_cuts(components: DataFrame, region: str) -> DataFrame:
    public = F.when(F.col("faixa_etaria").isin(R.YOUNG), R.YOUNG_PUBLIC).otherwise(R.OTHER_PUBLIC)
    rows = overlapping_cuts(components, region).withColumns(
        {"publico_original": public, "sexo_original": F.col("sexo")}
    )
    # Each row is counted under its own member and under the total of both dimensions:
    # the four grouping sets, with the original columns still there to be tested.
    return rows.withColumn("sexo", F.explode(F.array("sexo_original", F.lit(R.ALL)))).withColumn(
        "publico", F.explode(F.array("publico_original", F.lit(R.ALL)))
    )


def aggregate_cuts(components: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    return (
        _cube_of_cuts(components, region)
        .groupBy(*RATE_KEYS)
        .agg(*_sums(), *_group_means())
    )


def survey_rates(components: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    """Ready rates for region and areas, by sex and public, totals included.

    The ``publico`` column has three members: the total, young people and the rest.
    """
    c = F.col

    def pct(part: Column, whole: Column) -> Column:
        return ratio(part, whole, 1, 100)

    def mean(total: str, weight: str) -> Column:
        return F.try_divide(c(total), c(weight))

    underused = c("desocupados") + c("subocupados") + c("forca_potencial")
    columns = {
        "pessoas_amostra": c("pessoas_amostra"),
        "desocupados_amostra": c("desocupados_amostra"),
        "pessoas_idade_trabalhar": rounded(c("idade_trabalhar"), 0),
        "pessoas_forca_trabalho": rounded(c("forca_trabalho"), 0),
        "pessoas_ocupadas": rounded(c("ocupados"), 0),
        "pessoas_desocupadas": rounded(c("desocupados"), 0),
        "taxa_desocupacao_pct": pct(c("desocupados"), c("forca_trabalho")),
        "taxa_participacao_pct": pct(c("forca_trabalho"), c("idade_trabalhar")),
        "nivel_ocupacao_pct": pct(c("ocupados"), c("idade_trabalhar")),
        "taxa_informalidade_pct": pct(c("informais"), c("ocupados")),
        "conta_propria_pct": pct(c("conta_propria"), c("ocupados")),
        "contribuicao_previdencia_pct": pct(c("contribuintes_previdencia"), c("ocupados")),
        "taxa_subocupacao_pct": pct(c("subocupados"), c("ocupados")),
        "taxa_desalento_pct": pct(c("desalentados"), c("forca_potencial")),
        "taxa_subutilizacao_pct": pct(underused, c("forca_trabalho") + c("forca_potencial")),
        "renda_media_habitual": ratio(c("soma_renda"), c("peso_renda"), 2),
        "renda_media_real": ratio(c("soma_renda_real"), c("peso_renda_real"), 2),
        "razao_renda_mulher_homem_pct": pct(c("renda_mulher"), c("renda_homem")),
        "razao_renda_negra_branca_pct": pct(c("renda_negra"), c("renda_branca")),
        "razao_renda_informal_formal_pct": pct(
            mean("soma_renda_informal", "peso_renda_informal"), mean("soma_renda_formal", "peso_renda_formal")
        ),
        "amostra_suficiente": reliable(c("desocupados_amostra")),
    }
    return aggregate_cuts(components, region).select(*RATE_KEYS, *[v.alias(k) for k, v in columns.items()])


def weighted_by_category(silver: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    """Estimated people and interviewed people per position of the employed, for every cut."""
    position = F.col("posicao_ocupacao_codigo")
    counted = (
        silver.where(F.col("condicao_ocupacao") == 1)
        .groupBy(area_label(F.col("mora_em_fortaleza")).alias("area"), "ano", "trimestre", "posicao_ocupacao_codigo")
        .agg(amount_sum(F.col("peso")).alias("peso"), F.count(F.lit(1)).alias("n"))
    )
    return (
        with_whole(counted, "area", region)
        .groupBy("recorte", "ano", "trimestre", "posicao_ocupacao_codigo")
        .agg(rounded(amount_sum(F.col("peso")), 0).alias("pessoas"), F.sum("n").alias("pessoas_amostra"))
        .withColumn("posicao_ocupacao", simple_case(position, R.POSITION_LABELS, R.UNKNOWN_F))
    )


def sample_size(raw: DataFrame, weight: Column, event: Column, keys: Sequence[str] = ("ano", "trimestre")) -> DataFrame:
    return raw.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pessoas_entrevistadas"),
        F.count_if(event).alias("desocupados_na_amostra"),
        rounded(amount_sum(weight), 0).alias("populacao_representada"),
    )
