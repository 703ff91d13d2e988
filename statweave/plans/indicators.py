"""Questions answered from the gold tables. All inputs are gold DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as R
from ..operators.cuts import AMOUNT, amount_sum, one_way_profiles, ratio, with_total

c = F.col


def _pct(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part, whole, digits, 100)


def _ratio(total: str, count: str, digits: int = 2) -> Column:
    return ratio(F.sum(c(total).cast(AMOUNT)), F.sum(c(count).cast(AMOUNT)), digits)


def _young() -> Column:
    return c("faixa_etaria").isin(R.YOUNG)


def latest_period(df: DataFrame, year: str = "ano", quarter: str = "trimestre") -> DataFrame:
    """Rows of the newest period found in the table."""
    period = c(year) * 10 + c(quarter)
    return df.where(period == df.agg(F.max(period)).scalar())


def top_k(
    df: DataFrame, keys: Sequence[str], measure: str, alias: str, k: int, beside: Sequence[Column] = ()
) -> DataFrame:
    """The k largest sums; equal sums are ordered by the keys, so the answer is one answer.

    ``beside`` holds further aggregates of the same groups.
    """
    return (
        df.groupBy(*keys)
        .agg(F.sum(measure).alias(alias), *beside)
        .orderBy(F.desc(alias), *[F.asc_nulls_last(key) for key in keys])
        .limit(k)
    )


def balance_by_area(flow: DataFrame) -> DataFrame:
    return (
        flow.where(_young()).groupBy("municipio_nome").agg(F.sum("saldo").alias("saldo_jovens"))
        .orderBy(F.desc("saldo_jovens"))
    )


def median_by_sector(medians: DataFrame, age_band: str = "18-24", minimum: int = R.MIN_SAMPLE) -> DataFrame:
    return medians.where(
        (c("periodo") == R.ALL_MONTHS) & (c("municipio_nome") == R.ALL) & (c("faixa_etaria") == age_band)
        & (c("sexo") == R.ALL) & (c("cnae_secao_descricao") != R.ALL) & (c("admissoes_com_salario") >= minimum)
    ).select(
        c("cnae_secao_descricao").alias("setor"), "salario_mediano", "admissoes_com_salario"
    ).orderBy(F.desc("admissoes_com_salario"))


def top_sectors(flow: DataFrame, k: int = 10) -> DataFrame:
    young = flow.where(_young()).withColumnRenamed("cnae_secao_descricao", "setor")
    return top_k(young, ["setor"], "admissoes", "admissoes_jovens", k, [F.sum("saldo").alias("saldo_jovens")])


def monthly_balance(flow: DataFrame) -> DataFrame:
    return (
        flow.groupBy("competencia_mov", "preliminar").agg(F.sum("saldo").alias("saldo")).orderBy("competencia_mov")
    )


def median_point(medians: DataFrame, area: str, age_band: str = "18-24") -> DataFrame:
    return medians.where(
        (c("periodo") == R.ALL_MONTHS) & (c("municipio_nome") == area) & (c("faixa_etaria") == age_band)
        & (c("sexo") == R.ALL) & (c("cnae_secao_descricao") == R.ALL)
    ).select("salario_mediano", "admissoes_com_salario")


def latest_rate(rates: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    return latest_period(rates).where(
        (c("recorte") == region) & (c("sexo") == R.ALL) & (c("publico") == R.YOUNG_PUBLIC)
    ).select("ano", "trimestre", "taxa_desocupacao_pct", "desocupados_amostra", "amostra_suficiente")


def compare_areas(rates: DataFrame) -> DataFrame:
    return latest_period(rates).where(
        c("recorte").isin(R.CORE_AREA, R.OTHER_AREAS) & (c("sexo") == R.ALL) & (c("publico") == R.ALL)
    ).select("recorte", "taxa_desocupacao_pct", "taxa_informalidade_pct", "renda_media_habitual")


def mean_by_size(stock: DataFrame) -> DataFrame:
    return (
        stock.groupBy("porte_oficial")
        .agg(F.sum("vinculos").alias("empregos"), _ratio("soma_rem_dezembro", "n_rem_dezembro").alias("salario_medio"))
        .orderBy(F.desc("empregos"))
    )


def hire_shares(flow: DataFrame) -> DataFrame:
    """Share of hires that are young, and share that are apprentices."""
    hires = c("admissoes")
    sums = flow.agg(
        F.sum(hires).alias("admissoes"),
        F.sum(F.when(_young(), hires).otherwise(0)).alias("_jovens"),
        F.sum(F.when(c("aprendiz"), hires).otherwise(0)).alias("_aprendizes"),
    )
    return sums.select(
        "admissoes",
        _pct(c("_jovens"), c("admissoes")).alias("pct_jovens"),
        _pct(c("_aprendizes"), c("admissoes")).alias("pct_aprendizes"),
    )


def _with_share(profile: DataFrame, measure: str, within: Sequence[str]) -> DataFrame:
    shared = with_total(profile, measure, within, "_total")
    return shared.withColumn("pct", _pct(c(measure), c("_total"), 2)).drop("_total")


def stock_profile(stock: DataFrame) -> DataFrame:
    """Stock and share per member of each dimension; secondary education or more as one of them."""
    secondary = F.when(c("grau_instrucao_codigo") >= 7, "sim").otherwise("não")
    wide = stock.withColumn("medio_completo_ou_mais", secondary)
    dimensions = ["escolaridade", "faixa_etaria", "sexo", "raca_cor", "faixa_horas", "faixa_renda_sm",
                  "medio_completo_ou_mais"]
    return _with_share(one_way_profiles(wide, dimensions, "vinculos", ["ano_base"]), "vinculos", ["ano_base", "dimensao"])


def ratio_of_sums(stock: DataFrame, occupations: DataFrame) -> DataFrame:
    """Mean pay, pay per hour and tenure by sector; mean pay by major occupation group."""
    sectors = stock.groupBy(F.lit("setor").alias("dimensao"), c("cnae_secao_descricao").alias("membro")).agg(
        _ratio("soma_rem_dezembro", "n_rem_dezembro").alias("salario_medio"),
        _ratio("soma_rem_media_com_horas", "soma_horas_mes").alias("salario_hora"),
        _ratio("soma_tempo_emprego", "n_tempo_emprego").alias("tempo_medio_meses"),
    )
    groups = occupations.groupBy(F.lit("grande_grupo").alias("dimensao"), c("grande_grupo").alias("membro")).agg(
        _ratio("soma_rem_dezembro", "n_rem_dezembro").alias("salario_medio"),
    )
    return sectors.unionByName(groups, allowMissingColumns=True)


def pay_gaps(stock: DataFrame) -> DataFrame:
    """Ratio of mean pay between groups, in percent."""

    def mean(condition: Column) -> Column:
        return F.try_divide(
            amount_sum(F.when(condition, c("soma_rem_media"))), F.sum(F.when(condition, c("n_rem_media")))
        )

    pairs = {
        "razao_mulher_homem_pct": (c("sexo") == "Mulher", c("sexo") == "Homem"),
        "razao_negra_branca_pct": (c("raca_cor").isin(R.RACE_BLACK_MEMBERS), c("raca_cor") == R.RACE_WHITE),
        "razao_grande_micro_pct": (c("porte_oficial") == "Grande", c("porte_oficial") == "Micro"),
    }
    return stock.groupBy("ano_base").agg(*[_pct(mean(a), mean(b)).alias(name) for name, (a, b) in pairs.items()])


def deflated_mean(rates: DataFrame) -> DataFrame:
    return rates.where((c("sexo") == R.ALL) & (c("publico") == R.ALL)).select(
        "recorte", "ano", "trimestre", "renda_media_habitual", "renda_media_real",
        ratio(c("renda_media_real"), c("renda_media_habitual"), 4).alias("fator_real"),
    )


def share_over_time(components: DataFrame) -> DataFrame:
    """Women's share of the labour force in every quarter."""
    force = c("forca_trabalho")
    return components.groupBy("ano", "trimestre").agg(
        _pct(amount_sum(F.when(c("sexo") == "Mulher", force)), amount_sum(force)).alias("pct_mulheres")
    ).orderBy("ano", "trimestre")


def by_pay_band(flow: DataFrame) -> DataFrame:
    bands = flow.groupBy("faixa_salarial_sm").agg(F.sum("admissoes").alias("admissoes"))
    return _with_share(bands, "admissoes", [])


def small_firm_share(stock: DataFrame) -> DataFrame:
    small = c("porte_oficial").isin("Micro", "Pequena")
    return stock.groupBy("cnae_secao_descricao").agg(
        F.sum("vinculos").alias("empregos"),
        _pct(F.sum(F.when(small, c("vinculos")).otherwise(0)), F.sum("vinculos")).alias("pct_micro_pequena"),
    )


def top_occupations(occupations: DataFrame, k: int = 10) -> DataFrame:
    return top_k(occupations, ["cbo_codigo", "cbo_descricao"], "admissoes", "admissoes", k,
                 [F.sum("saldo").alias("saldo")])


def stock_occupations(occupations: DataFrame, k: int = 10) -> DataFrame:
    """Occupations with most jobs, and their mean pay."""
    mean = _ratio("soma_rem_dezembro", "n_rem_dezembro").alias("salario_medio")
    return top_k(occupations, ["cbo_codigo", "cbo_descricao"], "vinculos", "empregos", k, [mean])


def hire_profile(flow: DataFrame) -> DataFrame:
    profile = one_way_profiles(flow, ["faixa_etaria", "escolaridade", "sexo", "raca_cor"], "admissoes")
    return _with_share(profile, "admissoes", ["dimensao"])


def work_quality(rates: DataFrame, region: str = R.REGION_NAME) -> DataFrame:
    return latest_period(rates).where(
        (c("recorte") == region) & c("sexo").isin(R.ALL, "Mulher") & (c("publico") == R.ALL)
    ).select(
        "sexo", "taxa_informalidade_pct", "conta_propria_pct", "contribuicao_previdencia_pct",
        "taxa_subocupacao_pct", "taxa_desalento_pct", "taxa_subutilizacao_pct",
    )


def cross_profile(stock: DataFrame, first: str = "escolaridade", second: str = "sexo") -> DataFrame:
    """Stock by two dimensions, with the share of each second member inside the first."""
    pairs = stock.groupBy(c(first).alias("membro_1"), c(second).alias("membro_2")).agg(
        F.sum("vinculos").alias("vinculos")
    )
    return _with_share(pairs, "vinculos", ["membro_1"])


def rank_areas(indicators: DataFrame, quotients: DataFrame) -> DataFrame:
    """Areas from most to least unequal, each with the sector it is most specialised in."""
    best = quotients.groupBy("ano_base", "recorte").agg(
        F.max(F.struct("quociente_locacional", "cnae_secao")).alias("_m")
    )
    return (
        indicators.join(best, ["ano_base", "recorte"])
        .select(
            "ano_base", "recorte", "gini",
            c("_m.cnae_secao").alias("setor_mais_especializado"),
            c("_m.quociente_locacional").alias("maior_quociente"),
        )
        .orderBy("ano_base", F.desc("gini"), "recorte")
    )
