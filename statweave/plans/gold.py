"""Published gold tables: column types, column meanings, constraints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import expect_report
from ..sources.files import union_by_name, with_comments

_MONTH = "Month of the event as yyyymm."
_PRELIMINARY = "True for the three newest months, which later releases still revise."
_AREA = "Area code; six digits, without the check digit."
_AREA_NAME = "Area name inside the region."
_AGE = "Age band; people of unknown age have their own member."
_SEX = "Label shared by the three sources."
_RACE = "Label shared by the three sources."
_SECTION = "Letter of the economic activity section."
_SECTION_NAME = "Name of the economic activity section."
_ADDITIVE = "Additive: may be summed over any filter."
_NOT_ADDITIVE = "Not additive: read the row of the wanted cut, never sum or average."
_CUT = "Area, or the whole region. Cuts overlap; do not sum them."
_WEIGHTED = "People estimated by summed weights. Additive."
_RATE = "Percentage. " + _NOT_ADDITIVE

# --- fixed values: published tables, column -> (type, meaning) --------------------
TABLES: dict[str, dict[str, tuple[str, str]]] = {
    "caged_fluxo": {
        "competencia_mov": ("int", _MONTH),
        "preliminar": ("boolean", _PRELIMINARY),
        "municipio_codigo": ("int", _AREA),
        "municipio_nome": ("string", _AREA_NAME),
        "faixa_etaria": ("string", _AGE),
        "sexo": ("string", _SEX),
        "raca_cor": ("string", _RACE),
        "cnae_secao": ("string", _SECTION),
        "cnae_secao_descricao": ("string", _SECTION_NAME),
        "escolaridade": ("string", "Level of education."),
        "aprendiz": ("boolean", "True for apprentice contracts."),
        "faixa_salarial_sm": ("string", "Monthly pay in minimum wages of the year of the event."),
        "admissoes": ("bigint", "Hires; a cancelled hire counts minus one. " + _ADDITIVE),
        "desligamentos": ("bigint", "Separations; a cancelled one counts minus one. " + _ADDITIVE),
        "saldo": ("bigint", "Hires minus separations. " + _ADDITIVE),
    },
    "caged_ocupacoes": {
        "competencia_mov": ("int", _MONTH),
        "preliminar": ("boolean", _PRELIMINARY),
        "municipio_codigo": ("int", _AREA),
        "municipio_nome": ("string", _AREA_NAME),
        "faixa_etaria": ("string", _AGE),
        "sexo": ("string", _SEX),
        "cbo_codigo": ("string", "Six-digit occupation code."),
        "cbo_descricao": ("string", "Occupation name, or the code when the dictionary lacks it."),
        "admissoes": ("bigint", "Hires in the occupation. " + _ADDITIVE),
        "desligamentos": ("bigint", "Separations in the occupation. " + _ADDITIVE),
        "saldo": ("bigint", "Hires minus separations. " + _ADDITIVE),
    },
    "caged_salario_mediano": {
        "periodo": ("string", "Month, or the member for the whole window."),
        "municipio_nome": ("string", "Area or the total member."),
        "faixa_etaria": ("string", "Age band or the total member."),
        "sexo": ("string", "Sex or the total member."),
        "cnae_secao_descricao": ("string", "Section or the total member."),
        "salario_mediano": ("double", "Median monthly entry pay. " + _NOT_ADDITIVE),
        "admissoes_com_salario": ("bigint", "Hires behind the median; below 30 it is unreliable."),
    },
    "rais_estoque": {
        "ano_base": ("int", "Reference year; the stock is that of its last day."),
        "municipio_codigo": ("int", _AREA),
        "municipio_nome": ("string", _AREA_NAME),
        "cnae_secao": ("string", _SECTION),
        "cnae_secao_descricao": ("string", _SECTION_NAME),
        "porte_oficial": ("string", "Firm size; employers that are not firms have their own member."),
        "estatutario": ("boolean", "True for statutory public servants."),
        "faixa_etaria": ("string", _AGE),
        "sexo": ("string", _SEX),
        "raca_cor": ("string", _RACE),
        "grau_instrucao_codigo": ("int", "Code of the level of education, rising with the level."),
        "escolaridade": ("string", "Level of education."),
        "faixa_horas": ("string", "Band of weekly contract hours."),
        "faixa_renda_sm": ("string", "Mean pay of the year in minimum wages of that year."),
        "vinculos": ("bigint", "Contracts active on the last day. " + _ADDITIVE),
        "soma_rem_dezembro": ("double", "Sum of December pay; divide by its count for the mean."),
        "n_rem_dezembro": ("bigint", "Contracts with December pay reported."),
        "soma_rem_media": ("double", "Sum of mean yearly pay; divide by its count for the mean."),
        "n_rem_media": ("bigint", "Contracts with mean yearly pay reported."),
        "soma_tempo_emprego": ("double", "Sum of months in the job; divide by its count for the mean."),
        "n_tempo_emprego": ("bigint", "Contracts with tenure reported."),
        "soma_rem_media_com_horas": ("double", "Pay of contracts with hours; numerator of pay per hour."),
        "soma_horas_mes": ("decimal(25,3)", "Monthly hours of contracts with pay; denominator of pay per hour."),
    },
    "rais_ocupacoes": {
        "ano_base": ("int", "Reference year."),
        "municipio_codigo": ("int", _AREA),
        "municipio_nome": ("string", _AREA_NAME),
        "cbo_codigo": ("string", "Six-digit occupation code."),
        "cbo_descricao": ("string", "Occupation name, or the code when the dictionary lacks it."),
        "grande_grupo": ("string", "Major occupation group, from the first digit."),
        "vinculos": ("bigint", "Contracts active on the last day. " + _ADDITIVE),
        "soma_rem_dezembro": ("double", "Sum of December pay; divide by its count for the mean."),
        "n_rem_dezembro": ("bigint", "Contracts with December pay reported."),
    },
    "rais_indicadores_municipio": {
        "ano_base": ("int", "Reference year."),
        "recorte": ("string", _CUT),
        "estoque": ("bigint", "Contracts active on the last day."),
        "admissoes_rotatividade": ("bigint", "Entries of the year that count as turnover."),
        "desligamentos_rotatividade": ("bigint", "Exits of the year that count as turnover."),
        "taxa_rotatividade_pct": ("decimal(26,1)", "Smaller of entries and exits over the stock. " + _RATE),
        "gini": ("double", "Gini index of pay, 0 equal to 1 unequal. " + _NOT_ADDITIVE),
    },
    "rais_quociente_locacional": {
        "ano_base": ("int", "Reference year."),
        "recorte": ("string", _CUT),
        "cnae_secao": ("string", _SECTION),
        "cnae_secao_descricao": ("string", _SECTION_NAME),
        "vinculos_setor": ("bigint", "Contracts of the section in the cut."),
        "participacao_recorte_pct": ("decimal(27,2)", "Weight of the section in the cut. " + _RATE),
        "participacao_ceara_pct": ("decimal(27,2)", "Weight of the section in the wider region. " + _RATE),
        "quociente_locacional": ("double", "First weight over the second; above 1 is specialised."),
    },
    "pnad_mercado_trabalho": {
        "ano": ("int", "Survey year."),
        "trimestre": ("int", "Quarter, 1 to 4."),
        "area": ("string", "Core area or the others together; the two add up to the region."),
        "sexo": ("string", _SEX),
        "faixa_etaria": ("string", _AGE),
        "raca_grupo": ("string", "Group of race labels."),
        "pessoas_amostra": ("bigint", "People interviewed: the sample, not the population."),
        "desocupados_amostra": ("bigint", "Unemployed people interviewed."),
        "populacao": ("double", _WEIGHTED),
        "idade_trabalhar": ("double", "Of working age (14 or more). " + _WEIGHTED),
        "forca_trabalho": ("double", "In the labour force. " + _WEIGHTED),
        "ocupados": ("double", "Employed. " + _WEIGHTED),
        "desocupados": ("double", "Unemployed. " + _WEIGHTED),
        "informais": ("double", "Informally employed. " + _WEIGHTED),
        "conta_propria": ("double", "Self-employed. " + _WEIGHTED),
        "contribuintes_previdencia": ("double", "Contributing to social security. " + _WEIGHTED),
        "subocupados": ("double", "Wanting more hours. " + _WEIGHTED),
        "forca_potencial": ("double", "Potential labour force. " + _WEIGHTED),
        "desalentados": ("double", "Discouraged. " + _WEIGHTED),
        "soma_renda": ("double", "Weighted income of the employed."),
        "peso_renda": ("double", "Weights under the weighted income."),
        "soma_renda_real": ("double", "Weighted income in prices of the newest quarter."),
        "peso_renda_real": ("double", "Weights under the real income; quarters without a deflator have none."),
        "soma_renda_informal": ("double", "Weighted income of informal workers."),
        "peso_renda_informal": ("double", "Weights under it."),
        "soma_renda_formal": ("double", "Weighted income of formal workers."),
        "peso_renda_formal": ("double", "Weights under it."),
    },
    "pnad_indicadores": {
        "recorte": ("string", _CUT),
        "ano": ("int", "Survey year."),
        "trimestre": ("int", "Quarter, 1 to 4."),
        "sexo": ("string", "Sex or the total member."),
        "publico": ("string", "Total, young people (15 to 29) or everybody else."),
        "pessoas_amostra": ("bigint", "People interviewed."),
        "desocupados_amostra": ("bigint", "Unemployed people interviewed."),
        "pessoas_idade_trabalhar": ("double", "Estimated people of working age."),
        "pessoas_forca_trabalho": ("double", "Estimated labour force."),
        "pessoas_ocupadas": ("double", "Estimated employed people."),
        "pessoas_desocupadas": ("double", "Estimated unemployed people."),
        "taxa_desocupacao_pct": ("double", "Unemployed over labour force. " + _RATE),
        "taxa_participacao_pct": ("double", "Labour force over working age. " + _RATE),
        "nivel_ocupacao_pct": ("double", "Employed over working age. " + _RATE),
        "taxa_informalidade_pct": ("double", "Informal over employed. " + _RATE),
        "conta_propria_pct": ("double", "Self-employed over employed. " + _RATE),
        "contribuicao_previdencia_pct": ("double", "Contributors over employed. " + _RATE),
        "taxa_subocupacao_pct": ("double", "Wanting more hours over employed. " + _RATE),
        "taxa_desalento_pct": ("double", "Discouraged over potential labour force. " + _RATE),
        "taxa_subutilizacao_pct": ("double", "All underused over the extended labour force. " + _RATE),
        "renda_media_habitual": ("double", "Mean usual income of the employed. " + _NOT_ADDITIVE),
        "renda_media_real": ("double", "The same in prices of the newest quarter. " + _NOT_ADDITIVE),
        "razao_renda_mulher_homem_pct": ("double", "Mean income of women over men. " + _RATE),
        "razao_renda_negra_branca_pct": ("double", "Mean income of black over white people. " + _RATE),
        "razao_renda_informal_formal_pct": ("double", "Mean income of informal over formal. " + _RATE),
        "amostra_suficiente": ("boolean", "False below 30 interviewed unemployed people."),
    },
    "pnad_posicao_ocupacao": {
        "recorte": ("string", _CUT),
        "ano": ("int", "Survey year."),
        "trimestre": ("int", "Quarter, 1 to 4."),
        "posicao_ocupacao_codigo": ("int", "Code of the position in the occupation."),
        "posicao_ocupacao": ("string", "Name of the position."),
        "pessoas": ("double", "Estimated employed people in the position."),
        "pessoas_amostra": ("bigint", "People interviewed."),
    },
}

# Name of the constraint -> predicate, per table.
CONSTRAINTS = {
    "caged_fluxo": {"saldo_consistente": "saldo = admissoes - desligamentos"},
    "caged_salario_mediano": {"amostra_minima": "admissoes_com_salario >= 30"},
    "rais_estoque": {"contagens_coerentes": "n_rem_media <= vinculos AND n_rem_dezembro <= vinculos"},
    "rais_indicadores_municipio": {"gini_entre_0_e_1": "gini BETWEEN 0 AND 1"},
    "pnad_mercado_trabalho": {
        "ocupados_mais_desocupados_igual_forca":
            "abs(coalesce(ocupados, 0) + coalesce(desocupados, 0) - coalesce(forca_trabalho, 0)) < 1"
    },
    "pnad_indicadores": {"taxa_desocupacao_valida": "taxa_desocupacao_pct BETWEEN 0 AND 100"},
}


def comments(table: str) -> dict[str, str]:
    return {name: text for name, (_, text) in TABLES[table].items()}


def published(df: DataFrame, table: str) -> DataFrame:
    """The table as published: column order, types and comments."""
    columns = [F.col(name).cast(kind).alias(name) for name, (kind, _) in TABLES[table].items()]
    return with_comments(df.select(*columns), comments(table))


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, expectativa, linhas, violacoes) of the constraints of each given table."""
    return union_by_name(
        *[
            expect_report(df, CONSTRAINTS[name]).select(F.lit(name).alias("tabela"), "expectativa", "linhas", "violacoes")
            for name, df in tables.items()
        ]
    )
