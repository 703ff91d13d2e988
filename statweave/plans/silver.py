"""Silver layer: typed, labelled, rule-tagged rows of the three feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import functions as fn
from .. import rulebook as R
from ..operators.cleanse import cleanse
from ..operators.quality import expect_or_drop, observe_checks
from . import layout

AUDIT = ["_rescued_data", "_arquivo_origem"]


def flow_rules(rules: R.Rules) -> list[dict[str, Column]]:
    """Typing, then the rules over typed columns."""
    c = F.col
    by_code = {
        "efeito": fn.signed_effect(c("saldo_movimentacao"), c("origem_arquivo")),
        "faixa_etaria": fn.age_band(c("idade")),
        "salario_minimo": fn.year_lookup(fn.period_year(c("competencia_mov")), rules.wages),
    }
    pay = fn.plausible_value(c("salario_informado"), c("unidade_salario_codigo"), c("salario_minimo"))
    return [layout.typed(layout.FLOW, rules), by_code, {"salario_mensal": pay}]


def flow_checks(rules: R.Rules) -> tuple[dict[str, Column], dict[str, Column]]:
    """(checks that drop the row, checks that are only measured)."""
    c = F.col
    dropping = {
        "municipio_na_regiao": fn.in_set(c("municipio_codigo"), rules.areas),
        "efeito_valido": c("efeito").isin(-1, 1),
    }
    measured = {
        "salario_convertido": c("salario_informado").isNotNull(),
        "idade_plausivel": c("idade").between(14, 100),
        "tem_salario_mensal_plausivel": c("salario_mensal").isNotNull(),
        "ano_com_salario_minimo": c("salario_minimo").isNotNull(),
    }
    return dropping, measured


def stock_rules(rules: R.Rules) -> list[dict[str, Column]]:
    """Typing, then the rules over typed columns."""
    c = F.col
    entry, exit_ = fn.turnover_flags(
        c("mes_admissao"), c("mes_desligamento"), c("tipo_vinculo_codigo"), c("motivo_desligamento_codigo")
    )
    derived = {
        "elegivel_porte": fn.in_set(c("natureza_juridica_codigo"), R.SIZE_ELIGIBLE_NATURES),
        "estatutario": fn.in_set(c("tipo_vinculo_codigo"), R.STATUTORY_TYPES),
        "admissao_rotatividade": entry,
        "desligamento_rotatividade": exit_,
        "faixa_etaria": fn.age_band(c("idade")),
    }
    return [layout.typed(layout.STOCK, rules), derived]


def stock_checks(rules: R.Rules) -> tuple[dict[str, Column], dict[str, Column]]:
    c = F.col
    dropping = {"municipio_na_regiao": fn.in_set(c("municipio_codigo"), rules.areas)}
    measured = {
        "tem_secao_cnae": c("cnae_secao").isNotNull(),
        "tem_porte": c("porte").isNotNull() | (c("ibge_subsetor_codigo") == R.PUBLIC_SUBSECTOR),
        "idade_plausivel": c("idade").between(14, 100),
    }
    return dropping, measured


def survey_rules(rules: R.Rules) -> list[dict[str, Column]]:
    """Typing, then the rules over typed columns. NULL means "does not apply" and stays NULL."""
    c = F.col
    derived = {
        "faixa_etaria": fn.age_band(c("idade")),
        "informal": fn.informality(c("posicao_ocupacao_codigo"), c("negocio_cnpj_codigo")),
    }
    return [layout.typed(layout.SURVEY, rules), derived]


def survey_checks() -> tuple[dict[str, Column], dict[str, Column]]:
    return {"peso_positivo": F.col("peso") > 0}, {"idade_plausivel": F.col("idade").between(0, 130)}


def _checked(
    df: DataFrame, checks: tuple[dict[str, Column], dict[str, Column]], observation: Observation | None
) -> DataFrame:
    dropping, measured = checks
    if observation is not None:
        if "_rescued_data" in df.columns:
            measured = {**measured, "sem_dados_resgatados": F.col("_rescued_data").isNull()}
        df = observe_checks(df, {**dropping, **measured}, observation)
    return expect_or_drop(df, dropping)


def flow_silver(raw: DataFrame, rules: R.Rules, observation: Observation | None = None) -> DataFrame:
    return _checked(cleanse(raw, *flow_rules(rules), keep=AUDIT), flow_checks(rules), observation)


def with_section_and_size(typed: DataFrame, classes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Left lookups of the activity section and of the firm size."""
    return typed.join(classes, "cnae_classe", "left").join(
        sizes, ["ibge_subsetor_codigo", "tamanho_estabelecimento_codigo"], "left"
    )


def stock_silver(
    raw: DataFrame,
    rules: R.Rules,
    classes: DataFrame,
    sizes: DataFrame,
    observation: Observation | None = None,
) -> DataFrame:
    typed = with_section_and_size(cleanse(raw, *stock_rules(rules), keep=AUDIT), classes, sizes)
    return _checked(typed, stock_checks(rules), observation)


def stock_without_lookups(raw: DataFrame, rules: R.Rules) -> DataFrame:
    """Contracts of the region, typed, for tables that need neither section nor firm size."""
    return expect_or_drop(cleanse(raw, *stock_rules(rules), keep=AUDIT), stock_checks(rules)[0])


def wide_region(raw: DataFrame, rules: R.Rules) -> DataFrame:
    """The columns of the wider region that the location quotient needs, typed."""
    needed = ["ano_base", "municipio_codigo", "ativo_31_12", "cnae_classe"]
    return cleanse(raw, layout.typed(layout.STOCK, rules, *needed))


def survey_silver(raw: DataFrame, rules: R.Rules, observation: Observation | None = None) -> DataFrame:
    return _checked(cleanse(raw, *survey_rules(rules), keep=AUDIT), survey_checks(), observation)
