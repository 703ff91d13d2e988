"""Typed columns of the three feeds: tables of plain values, and the function that reads them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import functions as fn
from .. import rulebook as R

# --- fixed values: published column -> (source column, kind[, argument]) ----------
# A kind is a parser. "label" has the name of a dictionary of the rules as its argument;
# with any other kind an argument makes a flag: does the value equal it?
FLOW: dict[str, tuple] = {
    "origem_arquivo": ("tipo", "text"),
    "competencia_divulgacao": ("competencia", "text"),
    "competencia_mov": ("competenciamov", "int"),
    "competencia_dec": ("competenciadec", "int"),
    "competencia_exc": ("competenciaexc", "int"),
    "municipio_codigo": ("municipio", "int"),
    "cnae_secao": ("secao", "text"),
    "cnae_subclasse": ("subclasse", "text"),
    "cbo_codigo": ("cbo2002ocupacao", "text"),
    "saldo_movimentacao": ("saldomovimentacao", "int"),
    "tipo_movimentacao": ("tipomovimentacao", "int"),
    "categoria_codigo": ("categoria", "text"),
    "sexo_codigo": ("sexo", "text"),
    "sexo": ("sexo", "label", "flow_sex"),
    "raca_cor_codigo": ("racacor", "text"),
    "raca_cor": ("racacor", "label", "flow_race"),
    "grau_instrucao_codigo": ("graudeinstrucao", "int"),
    "idade": ("idade", "int"),
    "horas_contratuais": ("horascontratuais", "decimal comma"),
    "tempo_parcial": ("indtrabparcial", "text", "1"),
    "intermitente": ("indtrabintermitente", "text", "1"),
    "salario_informado": ("salario", "decimal comma"),
    "unidade_salario_codigo": ("unidadesalariocodigo", "text"),
}
STOCK: dict[str, tuple] = {
    "ano_base": ("ano_base", "text"),
    "municipio_codigo": ("municipio_codigo", "int"),
    "ativo_31_12": ("ind_vinculo_ativo_31_12_codigo", "int", 1),
    "tipo_vinculo_codigo": ("tipo_vinculo_codigo", "int"),
    "tipo_admissao_codigo": ("tipo_admissao_trabalhador_codigo", "int"),
    "mes_admissao": ("mes_admissao_codigo", "int"),
    "mes_desligamento": ("mes_desligamento_codigo", "int"),
    "motivo_desligamento_codigo": ("motivo_desligamento_codigo", "int"),
    "categoria_trabalhador_codigo": ("categoria_trabalhador_codigo", "int"),
    "cnae_classe": ("cnae_2_0_classe_codigo", "int"),
    "cnae_subclasse": ("cnae_2_0_subclasse_codigo", "int"),
    "natureza_juridica_codigo": ("natureza_juridica_codigo", "int"),
    "ibge_subsetor_codigo": ("ibge_subsetor_codigo", "int"),
    "tamanho_estabelecimento_codigo": ("tamanho_estabelecimento_codigo", "int"),
    "optante_simples": ("ind_estabelecimento_participante_simples_codigo", "int", 1),
    "cbo_codigo": ("cbo_2002_ocupacao_codigo", "trimmed text"),
    "sexo_codigo": ("sexo_codigo", "text"),
    "sexo": ("sexo_codigo", "label", "stock_sex"),
    "raca_cor_codigo": ("raca_cor_codigo", "text"),
    "raca_cor": ("raca_cor_codigo", "label", "stock_race"),
    "grau_instrucao_codigo": ("escolaridade_apos_2005_codigo", "int"),
    "idade": ("idade", "int"),
    "pcd": ("ind_portador_defic_codigo", "int", 1),
    "horas_contratuais": ("qtd_hora_contr", "int"),
    "tempo_emprego_meses": ("tempo_emprego", "decimal point"),
    "remuneracao_media_nominal": ("vl_rem_media_nom", "positive decimal point"),
    "remuneracao_dezembro_nominal": ("vl_rem_dezembro_nom", "positive decimal point"),
}
SURVEY: dict[str, tuple] = {
    "ano": ("ano", "int"),
    "trimestre": ("trimestre", "int"),
    "mora_em_fortaleza": ("capital", "text", R.METRO_CODE),
    "peso": ("peso", "decimal point"),
    "sexo_codigo": ("sexo", "text"),
    "sexo": ("sexo", "label", "survey_sex"),
    "raca_cor_codigo": ("cor_raca", "text"),
    "raca_cor": ("cor_raca", "label", "survey_race"),
    "idade": ("idade", "int"),
    "nivel_instrucao_codigo": ("nivel_instrucao", "int"),
    "condicao_forca_trabalho": ("condicao_forca_trabalho", "int"),
    "condicao_ocupacao": ("condicao_ocupacao", "int"),
    "forca_trabalho_potencial": ("forca_trabalho_potencial", "int"),
    "subocupado": ("subocupacao", "int", 1),
    "desalentado": ("desalento", "int", 1),
    "posicao_ocupacao_codigo": ("posicao_categoria", "int"),
    "grupamento_atividade_codigo": ("grupamento_atividade", "int"),
    "grupamento_ocupacional_codigo": ("grupamento_ocupacional", "int"),
    "contribui_previdencia": ("contribuicao_previdenciaria", "int", 1),
    "negocio_cnpj_codigo": ("negocio_cnpj", "int"),
    "rendimento_habitual": ("rendimento_habitual", "decimal point"),
    "rendimento_efetivo": ("rendimento_efetivo", "decimal point"),
}

_PARSERS = {
    "text": F.col,
    "trimmed text": F.trim,
    "int": fn.integer,
    "decimal comma": fn.decimal_comma,
    "decimal point": fn.decimal_point,
    "positive decimal point": fn.positive_or_null,
}


def typed(layout: Mapping[str, tuple], rules: R.Rules, *only: str) -> dict[str, Column]:
    """Expressions of a layout's columns, or of the named ones."""
    columns = {}
    for name in only or layout:
        source, kind, *argument = layout[name]
        if kind == "label":
            columns[name] = fn.conform_label(source, getattr(rules, *argument))
        else:
            value = _PARSERS[kind](source)
            columns[name] = fn.code_flag(value, *argument) if argument else value
    return columns
