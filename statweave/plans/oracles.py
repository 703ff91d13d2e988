"""Independent SQL for every registered query, written for DuckDB over the same tables.

The texts are built from shared common table expressions: the raw feeds, the typed
feeds and the small dimensions. They use row-level definitions (row numbers, UNION ALL
of cuts, CUBE over rows) where the operators use scalable forms, so an agreement is
evidence for the latter.
"""

from __future__ import annotations

import re

from .. import rulebook as R
from ..sources import feeds

ORACLES: dict[str, str] = {}


def _text(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _members(values) -> str:
    return "(" + ", ".join(map(_text, values)) + ")"


def _map_case(expr: str, table) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in table.items()) + " END"


def _round(expr: str, digits: int) -> str:
    """One rounding, half away from zero, of the value as a decimal."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(28, 8)), {digits}) AS DOUBLE)"


def _ratio(part: str, whole: str, digits: int, times: int = 1, whole_numbers: bool = False) -> str:
    """One division of whole numbers, rounded once, half away from zero."""
    def units(e: str) -> str:
        return f"CAST(({e}) AS HUGEINT)" if whole_numbers else f"CAST(CAST(({e}) AS DECIMAL(28, 8)) * 100000000 AS HUGEINT)"

    a, b = units(part), units(whole)
    return (f"(CASE WHEN ({a} < 0) <> ({b} < 0) THEN -1 ELSE 1 END * "
            f"CAST((abs({a}) * {2 * times * 10**digits}::HUGEINT + abs({b})) // nullif(2 * abs({b}), 0) AS DOUBLE) / {10**digits}.0::DOUBLE)")


def _money(expr: str) -> str:
    return f"CAST(round(sum(CAST({expr} AS DECIMAL(30, 8))), 2) AS DOUBLE)"


def _pct(part: str, whole: str, digits: int = 1) -> str:
    return _ratio(part, whole, digits, 100)


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def _int(expr: str) -> str:
    return f"TRY_CAST(trim({expr}) AS INTEGER)"


def _comma(expr: str) -> str:
    return f"TRY_CAST(replace(trim({expr}), ',', '.') AS DOUBLE)"


def _point(expr: str) -> str:
    return f"TRY_CAST(trim({expr}) AS DOUBLE)"


def _positive(expr: str) -> str:
    return f"CASE WHEN {_point(expr)} > 0 THEN {_point(expr)} END"


AGE = ("CASE WHEN {x} IS NULL OR {x} <= 0 THEN NULL WHEN {x} < 15 THEN '<15' WHEN {x} <= 17 THEN '15-17' "
       "WHEN {x} <= 24 THEN '18-24' WHEN {x} <= 29 THEN '25-29' ELSE '30+' END")
HOURS = ("CASE WHEN {x} IS NULL OR {x} <= 0 THEN 'Não informada' WHEN {x} <= 30 THEN '1. Até 30 horas' "
         "WHEN {x} <= 40 THEN '2. 31 a 40 horas' WHEN {x} <= 44 THEN '3. 41 a 44 horas' "
         "ELSE '4. 45 horas ou mais' END")
BAND = ("CASE WHEN {v} IS NULL OR {w} IS NULL THEN '{missing}' WHEN {v} / {w} <= 1 THEN '1. Até 1 SM' "
        "WHEN {v} / {w} <= 1.5 THEN '2. 1 a 1,5 SM' WHEN {v} / {w} <= 2 THEN '3. 1,5 a 2 SM' "
        "WHEN {v} / {w} <= 3 THEN '4. 2 a 3 SM' WHEN {v} / {w} <= 5 THEN '5. 3 a 5 SM' ELSE '6. Mais de 5 SM' END")
RACE_GROUP = ("CASE WHEN {x} = 'Branca' THEN 'Branca' WHEN {x} IN ('Preta', 'Parda') "
              "THEN 'Negra (preta ou parda)' ELSE 'Outras ou ignorada' END")
YOUNG = "('15-17', '18-24', '25-29')"
# Months as one running number; a month outside 1..12 has none.
MONTH = "CASE WHEN {m} % 100 BETWEEN 1 AND 12 THEN ({m} // 100) * 12 + {m} % 100 - 1 END"
WAGE_OF = f"CAST({_map_case('{y}', feeds.FEED_WAGES)} AS DOUBLE)"
INFORMAL = ("CASE WHEN {p} IS NULL THEN NULL ELSE {p} IN (2, 4, 10) "
            "OR ({p} IN (8, 9) AND coalesce({c} = 2, FALSE)) END")


def _month(m: str) -> str:
    return MONTH.format(m=m)


CTES: dict[str, str] = {
    "flow_raw": feeds.FLOW_SQL.format(lineitem="lineitem"),
    "stock_raw": feeds.STOCK_SQL.format(orders="orders"),
    "survey_raw": feeds.SURVEY_SQL.format(events="events"),
    "areas": "SELECT CAST(n_nationkey AS INTEGER) AS municipio_codigo, n_name AS municipio_nome FROM nation "
             f"WHERE n_nationkey < {feeds.REGION_SIZE}",
    "codes": _values(feeds.code_rows(), "dominio, codigo, descricao"),
    "classes": _values(feeds.class_rows(), "cnae_classe, cnae_secao"),
    "sizes": _values(R.firm_size_rows(), "subsetor, tamanho, porte"),
    "wages": "SELECT ano, CAST(valor AS DOUBLE) AS valor FROM "
             f"({_values(sorted(feeds.FEED_WAGES.items()), 'ano, valor')})",
    "deflators": "SELECT ano, trimestre, CAST(h AS DOUBLE) AS deflator_habitual, CAST(e AS DOUBLE) AS deflator_efetivo "
                 f"FROM ({_values(feeds.DEFLATORS, 'ano, trimestre, h, e')})",
    "flow_typed": f"""
        SELECT tipo, competencia, {_int('competenciamov')} AS competencia_mov,
               {_int('municipio')} AS municipio_codigo, secao AS cnae_secao, cbo2002ocupacao AS cbo_codigo,
               {_int('saldomovimentacao')} AS saldo_mov,
               {_int('saldomovimentacao')} * CASE WHEN tipo = 'EXC' THEN -1 ELSE 1 END AS efeito,
               categoria, {_map_case('sexo', R.FLOW_SEX)} AS sexo, {_map_case('racacor', R.FLOW_RACE)} AS raca_cor,
               {_int('graudeinstrucao')} AS grau, {AGE.format(x=_int('idade'))} AS faixa_etaria,
               {_int('idade')} AS idade,
               {_comma('salario')} AS salario, unidadesalariocodigo AS unidade,
               {WAGE_OF.format(y=_int('competenciamov') + ' // 100')} AS minimo
        FROM flow_raw""",
    "flow": f"""
        SELECT *, CASE WHEN unidade = '5' AND salario >= 0.3::DOUBLE * minimo AND salario <= 30.0::DOUBLE * minimo THEN salario END
                  AS salario_mensal, {_month('competencia_mov')} AS mes
        FROM flow_typed
        WHERE municipio_codigo BETWEEN 0 AND {feeds.REGION_SIZE - 1} AND efeito IN (-1, 1)""",
    "newest": "SELECT max(mes) AS ultimo FROM flow WHERE tipo = 'MOV'",
    "flow_rows": f"""
        SELECT f.competencia_mov, f.mes > n.ultimo - 3 AS preliminar, f.municipio_codigo, a.municipio_nome,
               coalesce(f.faixa_etaria, 'Não informada') AS faixa_etaria, coalesce(f.sexo, 'Não informado') AS sexo,
               coalesce(f.raca_cor, 'Não informada') AS raca_cor, f.cnae_secao,
               s.descricao AS cnae_secao_descricao, coalesce(e.descricao, 'Não informada') AS escolaridade,
               f.categoria = '103' AS aprendiz,
               {BAND.format(v='f.salario_mensal', w='f.minimo', missing='Sem salário mensal')} AS faixa_salarial_sm,
               f.cbo_codigo, coalesce(o.descricao, 'CBO ' || f.cbo_codigo) AS cbo_descricao,
               f.saldo_mov, f.efeito, f.tipo, f.salario_mensal
        FROM flow f CROSS JOIN newest n JOIN areas a ON a.municipio_codigo = f.municipio_codigo
        LEFT JOIN codes s ON s.dominio = 'secao' AND s.codigo = f.cnae_secao
        LEFT JOIN codes e ON e.dominio = 'graudeinstrucao' AND e.codigo = CAST(f.grau AS VARCHAR)
        LEFT JOIN codes o ON o.dominio = 'cbo2002ocupacao' AND o.codigo = f.cbo_codigo
        WHERE f.mes > n.ultimo - 12""",
    "medians": """
        SELECT CASE WHEN grouping(periodo) = 1 THEN 'Últimos 12 meses' ELSE periodo END AS periodo,
               CASE WHEN grouping(municipio_nome) = 1 THEN 'Todos' ELSE municipio_nome END AS municipio_nome,
               CASE WHEN grouping(faixa_etaria) = 1 THEN 'Todos' ELSE faixa_etaria END AS faixa_etaria,
               CASE WHEN grouping(sexo) = 1 THEN 'Todos' ELSE sexo END AS sexo,
               CASE WHEN grouping(setor) = 1 THEN 'Todos' ELSE setor END AS cnae_secao_descricao,
               round(quantile_disc(salario_mensal, 0.5), 2) AS salario_mediano, count(*) AS admissoes_com_salario
        FROM (SELECT CAST(competencia_mov AS VARCHAR) AS periodo, municipio_nome, faixa_etaria, sexo,
                     coalesce(cnae_secao_descricao, 'Não informado') AS setor, salario_mensal
              FROM flow_rows WHERE saldo_mov = 1 AND tipo IN ('MOV', 'FOR') AND salario_mensal IS NOT NULL) AS adm
        GROUP BY CUBE (periodo, municipio_nome, faixa_etaria, sexo, setor)""",
    "stock_typed": f"""
        SELECT ano_base, {_int('municipio_codigo')} AS municipio_codigo,
               {_int('ind_vinculo_ativo_31_12_codigo')} = 1 AS ativo, {_int('tipo_vinculo_codigo')} AS tipo_vinculo,
               {_int('mes_admissao_codigo')} AS mes_admissao, {_int('mes_desligamento_codigo')} AS mes_desligamento,
               {_int('motivo_desligamento_codigo')} AS motivo, {_int('cnae_2_0_classe_codigo')} AS cnae_classe,
               {_int('natureza_juridica_codigo')} AS natureza, {_int('ibge_subsetor_codigo')} AS subsetor,
               {_int('tamanho_estabelecimento_codigo')} AS tamanho, trim(cbo_2002_ocupacao_codigo) AS cbo_codigo,
               {_map_case('trim(sexo_codigo)', R.STOCK_SEX)} AS sexo,
               {_map_case('trim(raca_cor_codigo)', R.STOCK_RACE)} AS raca_cor,
               {_int('escolaridade_apos_2005_codigo')} AS grau, {AGE.format(x=_int('idade'))} AS faixa_etaria,
               {_int('qtd_hora_contr')} AS horas, {_point('tempo_emprego')} AS tempo,
               {_positive('vl_rem_media_nom')} AS media, {_positive('vl_rem_dezembro_nom')} AS dezembro
        FROM stock_raw""",
    "stock": f"""
        SELECT t.*, k.cnae_secao, z.porte, a.municipio_nome,
               t.natureza IN {_members(R.SIZE_ELIGIBLE_NATURES)} AS elegivel,
               t.tipo_vinculo IN (30, 31, 35) AS estatutario,
               t.mes_admissao BETWEEN 1 AND 12 AND t.tipo_vinculo NOT IN (30, 31, 35) AS entrada,
               t.mes_desligamento BETWEEN 1 AND 12 AND t.tipo_vinculo NOT IN (30, 31, 35)
                   AND t.motivo NOT IN {_members(R.NON_TURNOVER_REASONS)} AS saida
        FROM stock_typed t JOIN areas a ON a.municipio_codigo = t.municipio_codigo
        LEFT JOIN classes k ON k.cnae_classe = t.cnae_classe
        LEFT JOIN sizes z ON z.subsetor = t.subsetor AND z.tamanho = t.tamanho""",
    "stock_rows": f"""
        SELECT r.ano_base, r.municipio_codigo, r.municipio_nome, r.cnae_secao, s.descricao AS cnae_secao_descricao,
               CASE WHEN r.elegivel AND r.porte IS NOT NULL THEN r.porte ELSE 'Não se aplica' END AS porte_oficial,
               r.estatutario, coalesce(r.faixa_etaria, 'Não informada') AS faixa_etaria,
               coalesce(r.sexo, 'Não informado') AS sexo, coalesce(r.raca_cor, 'Não informada') AS raca_cor,
               r.grau AS grau_instrucao_codigo, coalesce(e.descricao, 'Não informada') AS escolaridade,
               {HOURS.format(x='r.horas')} AS faixa_horas,
               {BAND.format(v='r.media', w=WAGE_OF.format(y='r.ano_base'), missing='Sem remuneração informada')}
                   AS faixa_renda_sm,
               r.cbo_codigo, coalesce(o.descricao, 'CBO ' || r.cbo_codigo) AS cbo_descricao,
               coalesce({_map_case('substr(r.cbo_codigo, 1, 1)', R.MAJOR_GROUP_LABELS)}, 'Não informado') AS grande_grupo,
               r.dezembro, r.media, r.tempo, r.horas
        FROM stock r
        LEFT JOIN codes s ON s.dominio = 'secao' AND s.codigo = r.cnae_secao
        LEFT JOIN codes e ON e.dominio = 'graudeinstrucao' AND e.codigo = CAST(r.grau AS VARCHAR)
        LEFT JOIN codes o ON o.dominio = 'cbo2002ocupacao' AND o.codigo = r.cbo_codigo
        WHERE r.ativo""",
    "gini": """
        SELECT ano_base, recorte, 2 * sum(posicao * x) - (count(*) + 1) * sum(x) AS acima, count(*) * sum(x) AS base
        FROM (SELECT ano_base, recorte, x, row_number() OVER (PARTITION BY ano_base, recorte ORDER BY x) AS posicao
              FROM (SELECT ano_base, municipio_nome AS recorte, CAST(round(CAST(media AS DECIMAL(20, 8)) * 100, 0) AS HUGEINT) AS x
                    FROM stock WHERE ativo AND media > 0
                    UNION ALL
                    SELECT ano_base, 'RMF', CAST(round(CAST(media AS DECIMAL(20, 8)) * 100, 0) AS HUGEINT)
                    FROM stock WHERE ativo AND media > 0) AS u) AS v
        GROUP BY ano_base, recorte""",
    "turnover": f"""
        SELECT *, {_pct('least(admissoes_rotatividade, desligamentos_rotatividade)', 'estoque')} AS taxa_rotatividade_pct
        FROM (SELECT ano_base, CASE WHEN grouping(municipio_nome) = 1 THEN 'RMF' ELSE municipio_nome END AS recorte,
                     CAST(count(*) FILTER (WHERE ativo) AS BIGINT) AS estoque,
                     CAST(count(*) FILTER (WHERE entrada) AS BIGINT) AS admissoes_rotatividade,
                     CAST(count(*) FILTER (WHERE saida) AS BIGINT) AS desligamentos_rotatividade
              FROM stock GROUP BY GROUPING SETS ((ano_base, municipio_nome), (ano_base))) AS g""",
    "inequality": f"""
        SELECT t.*, {_ratio('g.acima', 'g.base', 3, whole_numbers=True)} AS gini FROM turnover t
        LEFT JOIN gini g ON g.ano_base = t.ano_base AND g.recorte = t.recorte""",
    "wide_stock": """
        SELECT t.ano_base, t.municipio_codigo, k.cnae_secao, count(*) AS vinculos_ativos
        FROM stock_typed t LEFT JOIN classes k ON k.cnae_classe = t.cnae_classe WHERE t.ativo GROUP BY ALL""",
    "quotients": f"""
        WITH w AS (SELECT * FROM wide_stock WHERE cnae_secao IS NOT NULL),
        estado AS (SELECT ano_base, cnae_secao, CAST(sum(vinculos_ativos) AS BIGINT) AS setor_estado,
                          CAST(sum(sum(vinculos_ativos)) OVER (PARTITION BY ano_base) AS BIGINT) AS total_estado
                   FROM w GROUP BY ano_base, cnae_secao),
        cortes AS (SELECT ano_base, a.municipio_nome AS recorte, cnae_secao, vinculos_ativos AS n
                   FROM w JOIN areas a USING (municipio_codigo)
                   UNION ALL
                   SELECT ano_base, 'RMF', cnae_secao, vinculos_ativos FROM w JOIN areas a USING (municipio_codigo)),
        setores AS (SELECT ano_base, recorte, cnae_secao, CAST(sum(n) AS BIGINT) AS vinculos_setor FROM cortes GROUP BY ALL),
        totais AS (SELECT *, CAST(sum(vinculos_setor) OVER (PARTITION BY ano_base, recorte) AS BIGINT) AS total FROM setores)
        SELECT t.ano_base, t.recorte, t.cnae_secao, s.descricao AS cnae_secao_descricao, t.vinculos_setor,
               {_pct('t.vinculos_setor', 't.total', 2)} AS participacao_recorte_pct,
               {_pct('e.setor_estado', 'e.total_estado', 2)} AS participacao_ceara_pct,
               {_ratio('t.vinculos_setor::HUGEINT * e.total_estado', 't.total::HUGEINT * e.setor_estado', 2, whole_numbers=True)}
                   AS quociente_locacional
        FROM totais t JOIN estado e ON e.ano_base = t.ano_base AND e.cnae_secao = t.cnae_secao
        LEFT JOIN codes s ON s.dominio = 'secao' AND s.codigo = t.cnae_secao""",
    "survey": f"""
        SELECT {_int('ano')} AS ano, {_int('trimestre')} AS trimestre, capital = '23' AS nucleo, {_point('peso')} AS peso,
               {_map_case('sexo', R.SURVEY_SEX)} AS sexo, {_map_case('cor_raca', R.SURVEY_RACE)} AS raca_cor,
               {_int('idade')} AS idade, {AGE.format(x=_int('idade'))} AS faixa_etaria,
               {_int('condicao_forca_trabalho')} AS forca, {_int('condicao_ocupacao')} AS ocupacao,
               {_int('forca_trabalho_potencial')} AS potencial, {_int('subocupacao')} = 1 AS subocupado,
               {_int('desalento')} = 1 AS desalentado, {_int('posicao_categoria')} AS posicao,
               {_int('contribuicao_previdenciaria')} = 1 AS contribui,
               {INFORMAL.format(p=_int('posicao_categoria'), c=_int('negocio_cnpj'))} AS informal,
               {_point('rendimento_habitual')} AS renda
        FROM survey_raw WHERE {_point('peso')} > 0""",
    "components": f"""
        SELECT p.ano, p.trimestre, CASE WHEN nucleo THEN 'Fortaleza' ELSE 'Demais municípios da RMF' END AS area,
               coalesce(sexo, 'Não informado') AS sexo, coalesce(faixa_etaria, 'Não informada') AS faixa_etaria,
               {RACE_GROUP.format(x='raca_cor')} AS raca_grupo,
               count(*) AS pessoas_amostra, count(*) FILTER (WHERE ocupacao = 2) AS desocupados_amostra,
               sum(peso) AS populacao, sum(CASE WHEN idade >= 14 THEN peso END) AS idade_trabalhar,
               sum(CASE WHEN forca = 1 THEN peso END) AS forca_trabalho,
               sum(CASE WHEN ocupacao = 1 THEN peso END) AS ocupados,
               sum(CASE WHEN ocupacao = 2 THEN peso END) AS desocupados,
               sum(CASE WHEN informal THEN peso END) AS informais,
               sum(CASE WHEN ocupacao = 1 AND posicao = 9 THEN peso END) AS conta_propria,
               sum(CASE WHEN contribui THEN peso END) AS contribuintes_previdencia,
               sum(CASE WHEN subocupado THEN peso END) AS subocupados,
               sum(CASE WHEN potencial = 1 THEN peso END) AS forca_potencial,
               sum(CASE WHEN desalentado THEN peso END) AS desalentados,
               sum(CASE WHEN ocupacao = 1 THEN renda * peso END) AS soma_renda,
               sum(CASE WHEN ocupacao = 1 AND renda IS NOT NULL THEN peso END) AS peso_renda,
               sum(CASE WHEN ocupacao = 1 THEN renda * peso * d.deflator_habitual END) AS soma_renda_real,
               sum(CASE WHEN ocupacao = 1 AND renda IS NOT NULL AND d.deflator_habitual IS NOT NULL THEN peso END)
                   AS peso_renda_real,
               sum(CASE WHEN ocupacao = 1 AND informal THEN renda * peso END) AS soma_renda_informal,
               sum(CASE WHEN ocupacao = 1 AND informal AND renda IS NOT NULL THEN peso END) AS peso_renda_informal,
               sum(CASE WHEN ocupacao = 1 AND NOT coalesce(informal, FALSE) THEN renda * peso END) AS soma_renda_formal,
               sum(CASE WHEN ocupacao = 1 AND NOT coalesce(informal, FALSE) AND renda IS NOT NULL THEN peso END)
                   AS peso_renda_formal
        FROM survey p LEFT JOIN deflators d ON d.ano = p.ano AND d.trimestre = p.trimestre GROUP BY ALL""",
    "cut_rows": """
        SELECT 'RMF' AS recorte, *,
               CASE WHEN faixa_etaria IN ('15-17', '18-24', '25-29') THEN 'Jovens (15 a 29 anos)' ELSE 'Demais' END AS grupo
        FROM components
        UNION ALL
        SELECT area, *,
               CASE WHEN faixa_etaria IN ('15-17', '18-24', '25-29') THEN 'Jovens (15 a 29 anos)' ELSE 'Demais' END
        FROM components""",
}

COUNTS = ["pessoas_amostra", "desocupados_amostra"]
SUMS = ["populacao", "idade_trabalhar", "forca_trabalho", "ocupados", "desocupados", "informais", "conta_propria",
        "contribuintes_previdencia", "subocupados", "forca_potencial", "desalentados"]
INCOME = ["soma_renda", "peso_renda", "soma_renda_real", "peso_renda_real", "soma_renda_informal",
          "peso_renda_informal", "soma_renda_formal", "peso_renda_formal"]

_sums = ", ".join(f"sum({name}) AS {name}" for name in SUMS + INCOME)
_counts = ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in COUNTS)


def _mean(condition: str) -> str:
    return (f"sum(CASE WHEN {condition} THEN soma_renda END) / "
            f"nullif(sum(CASE WHEN {condition} THEN peso_renda END), 0)")


CTES["cut_sums"] = f"""
        SELECT recorte, ano, trimestre,
               CASE WHEN grouping(sexo) = 1 THEN 'Todos' ELSE sexo END AS sexo,
               CASE WHEN grouping(grupo) = 1 THEN 'Todos' ELSE grupo END AS publico,
               {_counts}, {_sums},
               {_mean("sexo_o = 'Homem'")} AS renda_homem, {_mean("sexo_o = 'Mulher'")} AS renda_mulher,
               {_mean("raca_grupo = 'Branca'")} AS renda_branca,
               {_mean("raca_grupo = 'Negra (preta ou parda)'")} AS renda_negra
        FROM (SELECT *, sexo AS sexo_o FROM cut_rows) AS r
        GROUP BY GROUPING SETS ((recorte, ano, trimestre), (recorte, ano, trimestre, sexo),
                                (recorte, ano, trimestre, grupo), (recorte, ano, trimestre, sexo, grupo))"""
CTES["rates"] = f"""
        SELECT recorte, ano, trimestre, sexo, publico, pessoas_amostra, desocupados_amostra,
               {_round('idade_trabalhar', 0)} AS pessoas_idade_trabalhar,
               {_round('forca_trabalho', 0)} AS pessoas_forca_trabalho,
               {_round('ocupados', 0)} AS pessoas_ocupadas, {_round('desocupados', 0)} AS pessoas_desocupadas,
               {_pct('desocupados', 'forca_trabalho')} AS taxa_desocupacao_pct,
               {_pct('forca_trabalho', 'idade_trabalhar')} AS taxa_participacao_pct,
               {_pct('ocupados', 'idade_trabalhar')} AS nivel_ocupacao_pct,
               {_pct('informais', 'ocupados')} AS taxa_informalidade_pct,
               {_pct('conta_propria', 'ocupados')} AS conta_propria_pct,
               {_pct('contribuintes_previdencia', 'ocupados')} AS contribuicao_previdencia_pct,
               {_pct('subocupados', 'ocupados')} AS taxa_subocupacao_pct,
               {_pct('desalentados', 'forca_potencial')} AS taxa_desalento_pct,
               {_pct('desocupados + subocupados + forca_potencial', 'forca_trabalho + forca_potencial')}
                   AS taxa_subutilizacao_pct,
               {_ratio('soma_renda', 'peso_renda', 2)} AS renda_media_habitual,
               {_ratio('soma_renda_real', 'peso_renda_real', 2)} AS renda_media_real,
               {_pct('renda_mulher', 'renda_homem')} AS razao_renda_mulher_homem_pct,
               {_pct('renda_negra', 'renda_branca')} AS razao_renda_negra_branca_pct,
               {_pct(_div('soma_renda_informal', 'peso_renda_informal'), _div('soma_renda_formal', 'peso_renda_formal'))}
                   AS razao_renda_informal_formal_pct,
               desocupados_amostra >= 30 AS amostra_suficiente
        FROM cut_sums"""


def _needed(sql: str) -> list[str]:
    """CTE names the text uses, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def oracle(key: str, sql: str) -> None:
    parts = [f"{name} AS ({CTES[name]})" for name in _needed(sql)]
    ORACLES[key] = (f"WITH {', '.join(parts)} " if parts else "") + sql


def _n(source: str, keys: str, where: str = "") -> str:
    return f"SELECT {keys}, count(*) AS linhas FROM {source} {where} GROUP BY ALL"


# --- scans, sources, sinks ---------------------------------------------------------
oracle("ingest_incremental", _n("flow_raw", "tipo, competencia"))
oracle("ingest_ledger", "SELECT tipo, competencia, count(*) AS linhas_no_livro, 0::BIGINT AS resgatadas, count(*) AS linhas FROM flow_raw GROUP BY ALL")
oracle("ingest_partitioned", _n("flow_raw", "tipo, competencia, competenciamov"))
oracle("ingest_no_partition_cols", _n("survey_raw", "ano, trimestre"))
oracle("ingest_audit", "SELECT tipo, tipo AS tipo_no_caminho, count(*) AS com_origem, count(*) AS com_horario "
                       "FROM flow_raw GROUP BY ALL")
oracle("rescued_rows", """
    SELECT tipo, count(*) AS linhas, count(*) FILTER (WHERE idade = '13' AND tipo <> 'FOR' OR tipo = 'EXC') AS linhas_resgatadas,
           count(*) FILTER (WHERE idade = '13' AND tipo <> 'FOR') AS idades_resgatadas,
           count(*) FILTER (WHERE idade <> '13' OR tipo = 'FOR' AND idade IS NOT NULL) AS idades_convertidas, count(salario) AS com_salario
    FROM flow_raw GROUP BY tipo""")
oracle("union_by_name_missing", """
    SELECT tipo, competencia, count(*) AS linhas, count(CASE WHEN tipo = 'EXC' THEN 1 END) AS com_competenciaexc,
           count(CASE WHEN tipo = 'EXC' THEN 1 END) AS com_indicador
    FROM flow_raw GROUP BY tipo, competencia""")
_IN_REGION = f"WHERE CAST(trim({{}}) AS INTEGER) < {feeds.REGION_SIZE}"
oracle("scan_delimited_text", _n("flow_raw", "trim(municipio) AS municipio, secao AS secao",
                                 _IN_REGION.format("municipio")))
oracle("scan_latin1_csv", _n("stock_raw", "trim(municipio_codigo) AS municipio_codigo, ind_vinculo_ativo_31_12_codigo",
                             _IN_REGION.format("municipio_codigo")))
oracle("scan_fixed_width", f"""
    SELECT ano, trimestre, posicao_categoria, count(*) AS linhas,
           CAST(sum({_int('rendimento_habitual')}) AS BIGINT) AS soma_rendimento,
           {_money(_point('peso'))} AS soma_peso
    FROM survey_raw WHERE rm_ride = '23' GROUP BY ALL""")
oracle("scan_prefix_prune", _n(
    "stock_raw",
    "municipio_codigo, ind_vinculo_ativo_31_12_codigo, trim(cnae_2_0_classe_codigo) AS cnae_2_0_classe_codigo",
    "WHERE trim(cnae_2_0_classe_codigo) LIKE '102%'"))
oracle("dim_from_filenames", """
    SELECT 'cbo2002ocupacao' AS dominio, cbo2002ocupacao AS codigo, 'usado ' || count(*) AS descricao
    FROM flow_raw GROUP BY cbo2002ocupacao
    UNION ALL SELECT 'secao', secao, 'usado ' || count(*) FROM flow_raw GROUP BY secao""")
oracle("dim_from_json_map", """
    SELECT t.cnae_classe, k.cnae_secao, count(*) AS linhas
    FROM stock_typed t JOIN classes k ON k.cnae_classe = t.cnae_classe GROUP BY ALL""")
oracle("dim_literal", """
    SELECT subsetor AS ibge_subsetor_codigo, tamanho AS tamanho_estabelecimento_codigo, porte, count(*) AS linhas
    FROM stock_typed JOIN sizes USING (subsetor, tamanho) GROUP BY ALL""")
oracle("dim_typed_csv", f"""
    SELECT {_int('ano')} AS ano, {_int('trimestre')} AS trimestre, 1 + count(*) / 8.0::DOUBLE AS deflator_habitual
    FROM survey_raw GROUP BY ALL""")
oracle("query_files", _n("flow_raw", "tipo, competencia"))
oracle("sink_partitioned", _n("flow_raw", "tipo, competencia"))
CTES["release_steps"] = """
    SELECT competencia, tipo, n, row_number() OVER (ORDER BY competencia, list_position(['FOR', 'EXC', 'MOV'], tipo)) <= count(*) OVER () // 2 AS existe,
           count(*) FILTER (WHERE tipo = 'MOV') OVER (PARTITION BY competencia) > 0 AS no_prazo
    FROM (SELECT competencia, tipo, count(*) AS n FROM flow_raw GROUP BY competencia, tipo)"""
oracle("missing_periods", """
    SELECT tipo, competencia FROM release_steps
    WHERE NOT existe AND no_prazo AND competencia > (SELECT max(competencia) FROM release_steps WHERE existe AND tipo = 'MOV')""")
oracle("load_summary", """
    SELECT competencia, tipo, CASE WHEN NOT existe THEN n END AS linhas,
           CASE WHEN existe THEN 'já existia' ELSE 'carregado' END AS situacao,
           (SELECT count(DISTINCT competencia) FROM release_steps WHERE NOT existe AND no_prazo) AS novas_competencias
    FROM release_steps WHERE existe OR no_prazo""")
oracle("snake_columns", _n("stock_raw", "municipio_codigo, tipo_vinculo_codigo, "
                                        "motivo_desligamento_codigo AS motivo_desligamento_codigo"))

# --- typing and rules ---------------------------------------------------------------
oracle("parse_int", _n("flow_raw", f"{_int('municipio')} AS municipio_codigo, {_int('graudeinstrucao')} AS grau, "
                                   "municipio, graudeinstrucao"))
oracle("parse_decimal_comma", _n("flow_raw", f"{_comma('salario')} AS salario_informado, "
                                             f"{_comma('horascontratuais')} AS horas, salario"))
oracle("parse_decimal_point", _n("survey_raw", f"{_point('peso')} AS peso_num, "
                                               f"{_point('rendimento_habitual')} AS renda_num, peso"))
oracle("zero_as_null", f"""
    SELECT ano_base, count(*) AS linhas, count({_positive('vl_rem_media_nom')}) AS com_media,
           count({_positive('vl_rem_dezembro_nom')}) AS com_dezembro,
           {_money(_positive('vl_rem_media_nom'))} AS soma_media, min({_positive('vl_rem_media_nom')}) AS menor_media
    FROM stock_raw GROUP BY ano_base""")
oracle("conform_labels", " UNION ALL ".join(
    f"(SELECT '{name}' AS fonte, {_map_case(f'trim({s})', sexes)} AS sexo, {_map_case(f'trim({r})', races)} AS raca_cor, "
    f"count(*) AS linhas FROM {source} GROUP BY ALL)"
    for name, source, s, r, sexes, races in [
        ("fluxo", "flow_raw", "sexo", "racacor", R.FLOW_SEX, R.FLOW_RACE),
        ("estoque", "stock_raw", "sexo_codigo", "raca_cor_codigo", R.STOCK_SEX, R.STOCK_RACE),
        ("amostra", "survey_raw", "sexo", "cor_raca", R.SURVEY_SEX, R.SURVEY_RACE)]))
oracle("age_band", _n("flow_raw", f"{_int('idade')} AS idade_anos, {AGE.format(x=_int('idade'))} AS faixa_etaria, idade"))
oracle("year_lookup", _n("flow_raw", f"{_int('competenciamov')} // 100 AS ano, "
                                     f"{WAGE_OF.format(y=_int('competenciamov') + ' // 100')} AS salario_minimo"))
oracle("signed_effect", _n("flow_typed", "saldo_mov AS saldo, efeito, tipo"))
CTES["flow_all"] = CTES["flow"].split("WHERE")[0]
oracle("plausible_value", f"""
    SELECT competencia_mov // 100 AS ano, unidade AS unidade_salario_codigo, count(*) AS linhas,
           count(salario) AS informados, count(salario_mensal) AS plausiveis,
           {_money('salario_mensal')} AS soma_plausivel, min(salario_mensal) AS menor, max(salario_mensal) AS maior
    FROM flow_all GROUP BY ALL""")
oracle("ratio_bands", _n("flow_typed", "competencia_mov // 100 AS ano, " + BAND.format(
    v="salario", w="minimo", missing="Sem salário mensal") + " AS faixa_salarial_sm"))
oracle("hour_bands", _n("stock_typed", f"horas, {HOURS.format(x='horas')} AS faixa_horas"))
oracle("code_flags", _n("flow_raw", "categoria = '103' AS aprendiz, indtrabparcial = '1' AS tempo_parcial, "
                                    "indtrabintermitente = '1' AS intermitente, "
                                    f"{_int('tipomovimentacao')} = 97 AS tipo_ignorado"))
oracle("rule_set_membership", _n("stock_typed", f"natureza, natureza IN {_members(R.SIZE_ELIGIBLE_NATURES)} AS elegivel, "
                                                f"motivo, motivo IN {_members(R.NON_TURNOVER_REASONS)} AS motivo_excluido"))
CTES["stock_all"] = CTES["stock"].replace("t JOIN areas", "t LEFT JOIN areas")
oracle("turnover_flags", _n("stock_all", "mes_admissao, mes_desligamento, tipo_vinculo AS tipo_vinculo_codigo, "
                                         "motivo AS motivo_desligamento_codigo, entrada AS admissao_rotatividade, "
                                         "saida AS desligamento_rotatividade"))
oracle("firm_size", _n("stock", "subsetor AS ibge_subsetor_codigo, tamanho AS tamanho_estabelecimento_codigo, porte"))
oracle("eligible_size", _n("stock", "elegivel AS elegivel_porte, porte, CASE WHEN elegivel AND porte IS NOT NULL THEN porte "
                                    "ELSE 'Não se aplica' END AS porte_oficial"))
oracle("informality", _n("survey_raw", f"{_int('posicao_categoria')} AS posicao, {_int('negocio_cnpj')} AS cnpj, "
                         + INFORMAL.format(p=_int("posicao_categoria"), c=_int("negocio_cnpj")) + " AS informal"))
oracle("group_members", _n("survey_raw", f"{_map_case('cor_raca', R.SURVEY_RACE)} AS raca_cor, "
                           + RACE_GROUP.format(x=_map_case("cor_raca", R.SURVEY_RACE)) + " AS raca_grupo, cor_raca"))
oracle("simple_case_label", f"""
    SELECT coalesce({_map_case('substr(cbo_codigo, 1, 1)', R.MAJOR_GROUP_LABELS)}, 'Não informado') AS rotulo,
           count(*) AS linhas, 'grande_grupo' AS dimensao FROM stock_typed GROUP BY ALL
    UNION ALL
    SELECT coalesce({_map_case(_int('posicao_categoria'), R.POSITION_LABELS)}, 'Não informada'), count(*), 'posicao'
    FROM survey_raw GROUP BY ALL""")
oracle("default_label", """
    SELECT cbo2002ocupacao, coalesce(o.descricao, 'CBO ' || cbo2002ocupacao) AS cbo_descricao, count(*) AS linhas
    FROM flow_raw LEFT JOIN codes o ON o.dominio = 'cbo2002ocupacao' AND o.codigo = cbo2002ocupacao GROUP BY ALL""")
oracle("region_filter", _n("flow_raw", "municipio", _IN_REGION.format("municipio")))
oracle("active_only", _n("stock_typed", "ano_base, municipio_codigo", "WHERE ativo"))
oracle("rolling_window_flag", _n("flow CROSS JOIN newest", "competencia_mov, mes > ultimo - 3 AS preliminar",
                                 "WHERE mes > ultimo - 12").replace("flow CROSS JOIN newest", "flow JOIN newest ON TRUE"))
_FILLERS = {"bairros_fortaleza_codigo": "999997", "municipio_trab_codigo": "999999", "categoria_trabalhador_codigo": "999"}
_STOCK_COLUMNS = re.findall(r"\bAS (\w+),?\n", feeds.STOCK_SQL)
oracle("constant_columns", " UNION ALL ".join(
    f"SELECT '{name}' AS coluna, count(DISTINCT {name}) AS distintos, "
    + (_pct(f"count(CASE WHEN {name} = {_text(_FILLERS[name])} THEN 1 END)", "count(*)") if name in _FILLERS else "0.0::DOUBLE")
    + f" AS pct_sentinela, count(DISTINCT {name}) <= 1 AS constante FROM stock_raw" for name in _STOCK_COLUMNS))
oracle("drop_constant_columns", " UNION ALL ".join(
    f"SELECT '{name}' AS coluna, count({name}) AS preenchidas FROM stock_raw HAVING count(DISTINCT {name}) > 1"
    for name in _STOCK_COLUMNS))
oracle("latest_period", _n("survey", "ano, trimestre, nucleo AS mora_em_fortaleza",
                           "WHERE ano * 10 + trimestre = (SELECT max(ano * 10 + trimestre) FROM survey)"))

# --- joins --------------------------------------------------------------------------
oracle("join_inner_dim", _n("flow_typed JOIN areas USING (municipio_codigo)", "municipio_codigo, municipio_nome"))
oracle("join_left_domain", """
    SELECT f.secao AS cnae_secao, s.descricao AS cnae_secao_descricao, count(*) AS linhas
    FROM flow_raw f LEFT JOIN codes s ON s.dominio = 'secao' AND s.codigo = f.secao GROUP BY ALL""")
oracle("join_expr_key", """
    SELECT f.competencia_mov, f.grau, e.descricao AS escolaridade, w.valor AS salario_minimo, count(*) AS linhas
    FROM flow_typed f LEFT JOIN wages w ON w.ano = f.competencia_mov // 100
    LEFT JOIN codes e ON e.dominio = 'graudeinstrucao' AND e.codigo = CAST(f.grau AS VARCHAR) GROUP BY ALL""")
oracle("join_left_using", _n("stock_typed LEFT JOIN classes USING (cnae_classe)", "cnae_classe, cnae_secao"))
oracle("join_left_composite", """
    SELECT p.ano, p.trimestre, d.deflator_habitual, d.deflator_efetivo, count(*) AS linhas
    FROM survey p LEFT JOIN deflators d ON d.ano = p.ano AND d.trimestre = p.trimestre GROUP BY ALL""")
oracle("join_cross_scalar", """
    SELECT competencia_mov, CAST(ultimo - mes AS INTEGER) AS meses_ate_a_ultima, count(*) AS linhas
    FROM flow CROSS JOIN newest GROUP BY ALL""".replace("CROSS JOIN newest", "JOIN newest ON TRUE"))
oracle("join_aggregates", """
    SELECT ano_base, municipio_codigo, vinculos_area, vinculos_total
    FROM (SELECT ano_base, municipio_codigo, count(*) AS vinculos_area FROM stock_typed WHERE ativo GROUP BY ALL) AS a
    JOIN (SELECT ano_base, count(*) AS vinculos_total FROM stock_typed WHERE ativo GROUP BY ALL) AS b USING (ano_base)""")

# --- aggregations -------------------------------------------------------------------
_FLOW_MEASURES = ("CAST(sum(CASE WHEN saldo_mov = 1 THEN efeito ELSE 0 END) AS BIGINT) AS admissoes, "
                  "CAST(-sum(CASE WHEN saldo_mov = -1 THEN efeito ELSE 0 END) AS BIGINT) AS desligamentos, "
                  "CAST(sum(efeito) AS BIGINT) AS saldo")
CTES["flow_fact"] = f"""
    SELECT competencia_mov, preliminar, municipio_codigo, municipio_nome, faixa_etaria, sexo, raca_cor, cnae_secao,
           cnae_secao_descricao, escolaridade, aprendiz, faixa_salarial_sm, {_FLOW_MEASURES} FROM flow_rows GROUP BY ALL"""
CTES["flow_jobs"] = f"""
    SELECT competencia_mov, preliminar, municipio_codigo, municipio_nome, faixa_etaria, sexo, cbo_codigo, cbo_descricao,
           {_FLOW_MEASURES} FROM flow_rows GROUP BY ALL"""
_STOCK_PAY = f"count(*) AS vinculos, {_money('dezembro')} AS soma_rem_dezembro, count(dezembro) AS n_rem_dezembro"
CTES["stock_fact"] = f"""
    SELECT ano_base, municipio_codigo, municipio_nome, cnae_secao, cnae_secao_descricao, porte_oficial, estatutario,
           faixa_etaria, sexo, raca_cor, grau_instrucao_codigo, escolaridade, faixa_horas, faixa_renda_sm, {_STOCK_PAY},
           {_money('media')} AS soma_rem_media, count(media) AS n_rem_media,
           {_money('tempo')} AS soma_tempo_emprego, count(tempo) AS n_tempo_emprego,
           {_money('CASE WHEN horas > 0 THEN media END')} AS soma_rem_media_com_horas,
           round(sum(CASE WHEN horas > 0 AND media IS NOT NULL THEN horas END) * 4.345::DOUBLE, 3) AS soma_horas_mes
    FROM stock_rows GROUP BY ALL"""
CTES["stock_jobs"] = f"""
    SELECT ano_base, municipio_codigo, municipio_nome, cbo_codigo, cbo_descricao, grande_grupo, {_STOCK_PAY}
    FROM stock_rows GROUP BY ALL"""
oracle("flow_fact", "SELECT * FROM flow_fact")
oracle("maintained_flow", "SELECT * FROM flow_fact")
oracle("maintained_revisions", """
    SELECT competencia_mov, CAST(sum(CASE WHEN tipo = 'MOV' THEN efeito ELSE 0 END) AS BIGINT) AS saldo_no_prazo,
           CAST(sum(CASE WHEN tipo = 'FOR' THEN efeito ELSE 0 END) AS BIGINT) AS saldo_atrasado,
           CAST(sum(CASE WHEN tipo = 'EXC' THEN efeito ELSE 0 END) AS BIGINT) AS saldo_excluido,
           CAST(sum(efeito) AS BIGINT) AS saldo_revisado FROM flow WHERE mes IS NOT NULL GROUP BY competencia_mov""")
oracle("flow_by_occupation", "SELECT * FROM flow_jobs")
oracle("commented_schema", "SELECT * FROM flow_jobs")
oracle("group_by_all", _n("flow_raw", "tipo, competencia"))
oracle("median_cube", "SELECT * FROM medians")
oracle("stock_fact", "SELECT * FROM stock_fact")
oracle("stock_by_occupation", "SELECT * FROM stock_jobs")
oracle("gini", f"SELECT ano_base, recorte, {_ratio('acima', 'base', 5, whole_numbers=True)} AS gini FROM gini")
oracle("turnover_rate", "SELECT * FROM turnover")
oracle("inequality_turnover", "SELECT * FROM inequality")
oracle("regional_stock", "SELECT * FROM wide_stock")
oracle("location_quotient", "SELECT * FROM quotients")


def _rounded(names, digits: int = 4) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)


oracle("weighted_components", f"""
    SELECT ano, trimestre, area, sexo, faixa_etaria, raca_grupo, pessoas_amostra, desocupados_amostra,
           {_rounded(SUMS + INCOME)} FROM components""")
oracle("weighted_income", "SELECT ano, trimestre, raca_grupo, " + ", ".join(
    f"round(sum({name}), 4) AS {name}" for name in INCOME) + " FROM components GROUP BY ALL")
oracle("survey_rates", "SELECT * FROM rates")
oracle("ratio_of_group_means", f"""
    SELECT recorte, ano, trimestre, sexo, publico, {_pct('renda_mulher', 'renda_homem', 3)} AS razao_renda_mulher_homem_pct
    FROM cut_sums""")
oracle("weighted_by_category", f"""
    SELECT recorte, ano, trimestre, posicao AS posicao_ocupacao_codigo,
           coalesce({_map_case('posicao', R.POSITION_LABELS)}, 'Não informada') AS posicao_ocupacao,
           {_round('sum(peso)', 0)} AS pessoas, count(*) AS pessoas_amostra
    FROM (SELECT 'RMF' AS recorte, * FROM survey WHERE ocupacao = 1
          UNION ALL SELECT 'Fortaleza', * FROM survey WHERE ocupacao = 1 AND nucleo
          UNION ALL SELECT 'Demais municípios da RMF', * FROM survey WHERE ocupacao = 1 AND NOT nucleo) AS o
    GROUP BY ALL""")
oracle("rollup_of_components", f"SELECT ano, sexo, {_counts}, " + ", ".join(
    f"round(sum({name}), 4) AS {name}" for name in SUMS + INCOME) + " FROM components GROUP BY ano, sexo")
oracle("revision_reach", """
    SELECT tipo, min(competenciamov) AS mes_mais_antigo, max(competenciamov) AS mes_mais_recente,
           count(DISTINCT competenciamov) AS meses_afetados,
           count(*) FILTER (WHERE competenciamov < '200101') AS linhas_antes_da_janela
    FROM flow_raw GROUP BY tipo""")
oracle("conditional_counts", f"""
    SELECT tipo, count(*) AS linhas, count(*) FILTER (WHERE idade IS NULL) AS sem_idade,
           count(*) FILTER (WHERE {_comma('salario')} IS NULL) AS salario_ilegivel,
           count(*) FILTER (WHERE categoria = '103') AS aprendizes FROM flow_raw GROUP BY tipo""")
oracle("percentile_profile", f"""
    SELECT unidade AS unidadesalariocodigo, count(*) AS n, quantile_disc(salario, 0.01) AS p1,
           quantile_disc(salario, 0.5) AS p50, quantile_disc(salario, 0.99) AS p99,
           {_ratio('sum(salario)', 'count(salario)', 0)} AS media FROM flow_typed GROUP BY unidade""")
oracle("cast_success", f"""
    SELECT count(*) AS total, count(TRY_CAST(salario AS DOUBLE)) AS convertidos_sem_tratar,
           count({_comma('salario')}) AS convertidos_trocando_virgula FROM flow_raw""")
oracle("extremes_profile", """
    SELECT count(*) FILTER (WHERE salario = 0) AS zero, count(*) FILTER (WHERE salario > 0 AND salario < 1000) AS abaixo,
           count(*) FILTER (WHERE salario > 100000) AS acima, max(salario) AS maximo FROM flow_typed""")
oracle("band_profile", f"""
    SELECT CASE WHEN s IS NULL THEN '0. ilegível' WHEN s = 0 THEN '1. zero' WHEN w IS NULL THEN '7. ano sem SM'
                WHEN s < 0.1::DOUBLE * w THEN '2. abaixo de 0,1 SM' WHEN s < 0.3::DOUBLE * w THEN '3. 0,1 a 0,3 SM'
                WHEN s < 0.5::DOUBLE * w THEN '4. 0,3 a 0,5 SM' WHEN s <= 30.0::DOUBLE * w THEN '5. 0,5 a 30 SM'
                ELSE '6. acima de 30 SM' END AS faixa,
           count(*) AS n, {_ratio('sum(h)', 'count(h)', 1)} AS horas_semanais_media,
           count(*) FILTER (WHERE indtrabparcial = '1') AS tempo_parcial
    FROM (SELECT {_comma('salario')} AS s, {_comma('horascontratuais')} AS h, indtrabparcial,
                 {WAGE_OF.format(y=_int('competenciamov') + ' // 100')} AS w
          FROM flow_raw WHERE unidadesalariocodigo = '5') AS m GROUP BY ALL""")
oracle("rule_impact", f"""
    SELECT 'simples' AS regra, count(s) AS n, round(quantile_disc(s, 0.5), 0) AS mediana, {_ratio('sum(s)', 'count(s)', 0)} AS media
    FROM (SELECT salario AS s FROM flow_typed WHERE unidade = '5' AND salario > 0) AS a
    UNION ALL
    SELECT 'plausivel', count(s), round(quantile_disc(s, 0.5), 0), {_ratio('sum(s)', 'count(s)', 0)}
    FROM (SELECT salario AS s FROM flow_typed
          WHERE unidade = '5' AND salario BETWEEN 0.3::DOUBLE * minimo AND 30.0::DOUBLE * minimo) AS b""")
oracle("sentinel_counts", f"""
    SELECT 'categoria = 999' AS o_que, count(*) AS n FROM flow_raw WHERE categoria = '999'
    UNION ALL SELECT 'graudeinstrucao = 80', count(*) FROM flow_raw WHERE graudeinstrucao = '80'
    UNION ALL SELECT 'remuneração = .00', count(*) FROM stock_raw WHERE vl_rem_media_nom = '.00'
    UNION ALL SELECT 'sem condição na força de trabalho', count(*) FROM survey_raw WHERE condicao_forca_trabalho IS NULL
    UNION ALL SELECT 'desses, menos de 14 anos', count(*) FROM survey_raw
    WHERE condicao_forca_trabalho IS NULL AND {_int('idade')} < 14""")
oracle("code_frequency", """
    SELECT 'fluxo' AS fonte, racacor AS codigo, count(*) AS n FROM flow_raw GROUP BY ALL
    UNION ALL SELECT 'estoque', raca_cor_codigo, count(*) FROM stock_raw GROUP BY ALL
    UNION ALL SELECT 'amostra', cor_raca, count(*) FROM survey_raw GROUP BY ALL""")
oracle("sample_size", f"""
    SELECT ano, trimestre, count(*) AS pessoas_entrevistadas,
           count(*) FILTER (WHERE condicao_ocupacao = '2') AS desocupados_na_amostra,
           {_round(f"sum({_point('peso')})", 0)} AS populacao_representada FROM survey_raw GROUP BY ALL""")
oracle("status_counts", "SELECT ind_vinculo_ativo_31_12_codigo, count(*) AS n FROM stock_raw GROUP BY ALL")
oracle("reconcile_counts", """
    SELECT ano_base, count(*) FILTER (WHERE vl_rem_media_nom <> '.00') AS linhas, count(*) AS esperado,
           count(*) FILTER (WHERE vl_rem_media_nom <> '.00') - count(*) AS diferenca FROM stock_raw GROUP BY ano_base""")

# --- windows, sorts, set operations -------------------------------------------------
oracle("share_of_total", """
    SELECT cnae_secao, CAST(sum(vinculos_ativos) AS BIGINT) AS parte,
           CAST(sum(sum(vinculos_ativos)) OVER () AS BIGINT) AS total
    FROM wide_stock WHERE cnae_secao IS NOT NULL GROUP BY cnae_secao""")
oracle("sorted_output", _n("flow_raw", "tipo, competenciamov") + " ORDER BY tipo, competenciamov DESC")
oracle("top_k", "SELECT salario, count(*) AS n FROM flow_raw GROUP BY salario ORDER BY n DESC, salario LIMIT 5")
oracle("overlapping_cuts", """
    SELECT recorte, ano, trimestre, CAST(sum(pessoas_amostra) AS BIGINT) AS pessoas_amostra,
           round(sum(populacao), 2) AS populacao FROM cut_rows GROUP BY ALL""")
oracle("union_all", f"""
    SELECT 'fluxo' AS tabela, count(*) AS linhas, count(*) FILTER (WHERE {_comma('salario')} IS NULL) AS sem_valor
    FROM flow_raw
    UNION ALL SELECT 'estoque', count(*), count(*) FILTER (WHERE media IS NULL) FROM stock_typed
    UNION ALL SELECT 'amostra', count(*), count(*) FILTER (WHERE {_point('rendimento_habitual')} IS NULL) FROM survey_raw""")
oracle("late_revisions", """
    SELECT competencia_mov, CAST(sum(CASE WHEN tipo = 'MOV' THEN efeito ELSE 0 END) AS BIGINT) AS saldo_no_prazo,
           CAST(sum(CASE WHEN tipo = 'FOR' THEN efeito ELSE 0 END) AS BIGINT) AS saldo_atrasado,
           CAST(sum(CASE WHEN tipo = 'EXC' THEN efeito ELSE 0 END) AS BIGINT) AS saldo_excluido,
           CAST(sum(efeito) AS BIGINT) AS saldo_revisado FROM flow GROUP BY competencia_mov""")

# --- quality ------------------------------------------------------------------------
def _report(source: str, checks: dict[str, str], table: str | None = None) -> str:
    lead = f"'{table}' AS tabela, " if table else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS expectativa, count(*) AS linhas, "
        f"count(*) FILTER (WHERE NOT coalesce({predicate}, FALSE)) AS violacoes FROM {source}"
        for name, predicate in checks.items())


_IN_REGION_CODE = f"municipio_codigo BETWEEN 0 AND {feeds.REGION_SIZE - 1}"
_FLOW_CHECKS = {
    "municipio_na_regiao": _IN_REGION_CODE,
    "efeito_valido": "efeito IN (-1, 1)",
    "salario_convertido": "salario IS NOT NULL",
    "idade_plausivel": "idade BETWEEN 14 AND 100",
    "tem_salario_mensal_plausivel": "salario_mensal IS NOT NULL",
    "ano_com_salario_minimo": "minimo IS NOT NULL",
}
oracle("expect_report", _report("flow_all", _FLOW_CHECKS))
oracle("expect_or_drop", f"""
    SELECT municipio_codigo, count(*) AS linhas, CAST(sum(efeito) AS BIGINT) AS efeito, NULL::VARCHAR AS expectativa,
           NULL::BIGINT AS descartadas, NULL::BIGINT AS so_por_ela FROM flow GROUP BY municipio_codigo
    UNION ALL
    SELECT NULL, NULL, NULL, 'municipio_na_regiao', count(*) FILTER (WHERE NOT r), count(*) FILTER (WHERE NOT r AND e)
    FROM (SELECT coalesce({_IN_REGION_CODE}, FALSE) AS r, coalesce(efeito IN (-1, 1), FALSE) AS e FROM flow_all) AS x
    UNION ALL
    SELECT NULL, NULL, NULL, 'efeito_valido', count(*) FILTER (WHERE NOT e), count(*) FILTER (WHERE NOT e AND r)
    FROM (SELECT coalesce({_IN_REGION_CODE}, FALSE) AS r, coalesce(efeito IN (-1, 1), FALSE) AS e FROM flow_all) AS x""")
CTES["release_lots"] = """
    SELECT tipo, competencia, CAST((row_number() OVER (ORDER BY competencia, list_position(['FOR', 'EXC', 'MOV'], tipo)) - 1)
           // ((count(*) OVER () + 2) // 3) AS INTEGER) AS lote FROM (SELECT DISTINCT tipo, competencia FROM flow_raw)"""
oracle("quality_history", " UNION ALL ".join(
    f"SELECT lote, '{name}' AS expectativa, count(*) AS linhas, count(*) FILTER (WHERE NOT coalesce({predicate}, FALSE)) AS violacoes "
    f"FROM flow_all JOIN release_lots USING (tipo, competencia) GROUP BY lote" for name, predicate in _FLOW_CHECKS.items()))
oracle("gold_constraints", " UNION ALL ".join([
    _report("flow_fact", {"saldo_consistente": "saldo = admissoes - desligamentos"}, "caged_fluxo"),
    _report("medians", {"amostra_minima": "admissoes_com_salario >= 30"}, "caged_salario_mediano"),
    _report("stock_fact", {"contagens_coerentes": "n_rem_media <= vinculos AND n_rem_dezembro <= vinculos"}, "rais_estoque"),
    _report("inequality", {"gini_entre_0_e_1": "gini BETWEEN 0 AND 1"}, "rais_indicadores_municipio"),
    _report("components", {"ocupados_mais_desocupados_igual_forca":
            "abs(coalesce(ocupados, 0) + coalesce(desocupados, 0) - coalesce(forca_trabalho, 0)) < 1"}, "pnad_mercado_trabalho"),
    _report("rates", {"taxa_desocupacao_valida": "taxa_desocupacao_pct BETWEEN 0 AND 100"}, "pnad_indicadores")]))
oracle("expect_conditional", _report("stock", {
    "tem_porte": "porte IS NOT NULL OR subsetor = 24", "tem_porte_sem_excecao": "porte IS NOT NULL"}))
oracle("reliability_flag", """
    SELECT ano, trimestre, faixa_etaria, area, CAST(sum(desocupados_amostra) AS BIGINT) AS desocupados_amostra,
           sum(desocupados_amostra) >= 30 AS amostra_suficiente FROM components GROUP BY ALL""")

# --- indicators ---------------------------------------------------------------------
_HIRES = "CAST(sum(admissoes) AS BIGINT)"
oracle("q_balance_by_area", f"""
    SELECT municipio_nome, CAST(sum(saldo) AS BIGINT) AS saldo_jovens FROM flow_fact
    WHERE faixa_etaria IN {YOUNG} GROUP BY municipio_nome""")
oracle("q_median_by_sector", """
    SELECT cnae_secao_descricao AS setor, salario_mediano, admissoes_com_salario FROM medians
    WHERE periodo = 'Últimos 12 meses' AND municipio_nome = 'Todos' AND faixa_etaria = '30+' AND sexo = 'Todos'
      AND cnae_secao_descricao <> 'Todos' AND admissoes_com_salario >= 3""")
oracle("q_top_sectors", f"""
    SELECT cnae_secao_descricao AS setor, {_HIRES} AS admissoes_jovens, CAST(sum(saldo) AS BIGINT) AS saldo_jovens
    FROM flow_fact WHERE faixa_etaria IN {YOUNG}
    GROUP BY cnae_secao_descricao ORDER BY admissoes_jovens DESC, setor NULLS LAST LIMIT 10""")
oracle("q_monthly_balance", """
    SELECT competencia_mov, preliminar, CAST(sum(saldo) AS BIGINT) AS saldo FROM flow_fact GROUP BY ALL""")
oracle("q_median_point", """
    SELECT salario_mediano, admissoes_com_salario FROM medians
    WHERE periodo = 'Últimos 12 meses' AND municipio_nome = 'NATION_4' AND faixa_etaria = '18-24' AND sexo = 'Todos'
      AND cnae_secao_descricao = 'Todos'""")
_LATEST = "ano * 10 + trimestre = (SELECT max(ano * 10 + trimestre) FROM rates)"
oracle("q_latest_rate", f"""
    SELECT ano, trimestre, taxa_desocupacao_pct, desocupados_amostra, amostra_suficiente FROM rates
    WHERE recorte = 'RMF' AND sexo = 'Todos' AND publico = 'Jovens (15 a 29 anos)' AND {_LATEST}""")
oracle("q_compare_areas", f"""
    SELECT recorte, taxa_desocupacao_pct, taxa_informalidade_pct, renda_media_habitual FROM rates
    WHERE recorte IN ('Fortaleza', 'Demais municípios da RMF') AND sexo = 'Todos' AND publico = 'Todos' AND {_LATEST}""")
oracle("q_mean_by_size", f"""
    SELECT porte_oficial, CAST(sum(vinculos) AS BIGINT) AS empregos,
           {_ratio('sum(soma_rem_dezembro)', 'sum(n_rem_dezembro)', 2)} AS salario_medio
    FROM stock_fact GROUP BY porte_oficial""")
oracle("q_share_of_total", f"""
    SELECT {_HIRES} AS admissoes,
           {_pct(f'sum(CASE WHEN faixa_etaria IN {YOUNG} THEN admissoes ELSE 0 END)', 'sum(admissoes)')} AS pct_jovens,
           {_pct('sum(CASE WHEN aprendiz THEN admissoes ELSE 0 END)', 'sum(admissoes)')} AS pct_aprendizes
    FROM flow_fact""")


def _profile(source: str, dimensions: dict[str, str], measure: str, period: str = "") -> str:
    lead = f"{period}, " if period else ""
    rows = " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS dimensao, {expr} AS membro, CAST(sum({measure}) AS BIGINT) AS {measure} "
        f"FROM {source} GROUP BY ALL" for name, expr in dimensions.items())
    share = _pct(measure, f"sum({measure}) OVER (PARTITION BY {lead}dimensao)", 2)
    return f"SELECT {lead}dimensao, membro, {measure}, {share} AS pct FROM ({rows}) AS p"


oracle("q_stock_profile", _profile("stock_fact", {
    **{d: d for d in ("escolaridade", "faixa_etaria", "sexo", "raca_cor", "faixa_horas", "faixa_renda_sm")},
    "medio_completo_ou_mais": "CASE WHEN grau_instrucao_codigo >= 7 THEN 'sim' ELSE 'não' END"}, "vinculos", "ano_base"))
oracle("q_ratio_of_sums", f"""
    SELECT 'setor' AS dimensao, cnae_secao_descricao AS membro,
           {_ratio('sum(soma_rem_dezembro)', 'sum(n_rem_dezembro)', 2)} AS salario_medio,
           {_ratio('sum(soma_rem_media_com_horas)', 'sum(soma_horas_mes)', 2)} AS salario_hora,
           {_ratio('sum(soma_tempo_emprego)', 'sum(n_tempo_emprego)', 2)} AS tempo_medio_meses
    FROM stock_fact GROUP BY ALL
    UNION ALL
    SELECT 'grande_grupo', grande_grupo, {_ratio('sum(soma_rem_dezembro)', 'sum(n_rem_dezembro)', 2)},
           CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
    FROM stock_jobs GROUP BY ALL""")


def _pay(condition: str) -> str:
    return (f"(sum(CASE WHEN {condition} THEN soma_rem_media END) / "
            f"nullif(sum(CASE WHEN {condition} THEN n_rem_media END), 0))")


def _gap(a: str, b: str) -> str:
    return _pct(_pay(a), _pay(b))


oracle("q_pay_gaps", f"""
    SELECT ano_base, {_gap("sexo = 'Mulher'", "sexo = 'Homem'")} AS razao_mulher_homem_pct,
           {_gap("raca_cor IN ('Preta', 'Parda')", "raca_cor = 'Branca'")} AS razao_negra_branca_pct,
           {_gap("porte_oficial = 'Grande'", "porte_oficial = 'Micro'")} AS razao_grande_micro_pct
    FROM stock_fact GROUP BY ano_base""")
oracle("q_deflated_mean", f"""
    SELECT recorte, ano, trimestre, renda_media_habitual, renda_media_real,
           {_ratio('renda_media_real', 'renda_media_habitual', 4)} AS fator_real
    FROM rates WHERE sexo = 'Todos' AND publico = 'Todos'""")
oracle("q_share_over_time", f"""
    SELECT ano, trimestre, {_pct("sum(CASE WHEN sexo = 'Mulher' THEN forca_trabalho END)", 'sum(forca_trabalho)')}
           AS pct_mulheres FROM components GROUP BY ALL""")
oracle("q_by_band", f"""
    SELECT faixa_salarial_sm, admissoes, {_pct('admissoes', 'sum(admissoes) OVER ()', 2)} AS pct
    FROM (SELECT faixa_salarial_sm, {_HIRES} AS admissoes FROM flow_fact GROUP BY ALL) AS b""")
oracle("q_small_firm_share", f"""
    SELECT cnae_secao_descricao, CAST(sum(vinculos) AS BIGINT) AS empregos,
           {_pct("sum(CASE WHEN porte_oficial IN ('Micro', 'Pequena') THEN vinculos ELSE 0 END)", 'sum(vinculos)')}
           AS pct_micro_pequena FROM stock_fact GROUP BY ALL""")
oracle("q_top_occupations", f"""
    SELECT cbo_codigo, cbo_descricao, {_HIRES} AS admissoes, CAST(sum(saldo) AS BIGINT) AS saldo FROM flow_jobs GROUP BY ALL
    ORDER BY admissoes DESC, cbo_codigo, cbo_descricao LIMIT 10""")
oracle("q_stock_occupations", f"""
    SELECT cbo_codigo, cbo_descricao, CAST(sum(vinculos) AS BIGINT) AS empregos,
           {_ratio('sum(soma_rem_dezembro)', 'sum(n_rem_dezembro)', 2)} AS salario_medio
    FROM stock_jobs GROUP BY ALL ORDER BY empregos DESC, cbo_codigo, cbo_descricao LIMIT 10""")
oracle("q_hire_profile", _profile("flow_fact", {
    d: d for d in ("faixa_etaria", "escolaridade", "sexo", "raca_cor")}, "admissoes"))
oracle("q_work_quality", f"""
    SELECT sexo, taxa_informalidade_pct, conta_propria_pct, contribuicao_previdencia_pct, taxa_subocupacao_pct,
           taxa_desalento_pct, taxa_subutilizacao_pct FROM rates
    WHERE recorte = 'RMF' AND sexo IN ('Todos', 'Mulher') AND publico = 'Todos' AND {_LATEST}""")
oracle("q_cross_profile", f"""
    SELECT membro_1, membro_2, vinculos, {_pct('vinculos', 'sum(vinculos) OVER (PARTITION BY membro_1)', 2)} AS pct
    FROM (SELECT escolaridade AS membro_1, sexo AS membro_2, CAST(sum(vinculos) AS BIGINT) AS vinculos
          FROM stock_fact GROUP BY ALL) AS x""")
oracle("q_rank_areas", """
    SELECT i.ano_base, i.recorte, i.gini, q.cnae_secao AS setor_mais_especializado,
           q.quociente_locacional AS maior_quociente
    FROM inequality i JOIN (SELECT *, row_number() OVER (PARTITION BY ano_base, recorte
                                   ORDER BY quociente_locacional DESC, cnae_secao DESC) AS ordem FROM quotients) AS q
      ON q.ano_base = i.ano_base AND q.recorte = i.recorte AND q.ordem = 1""")
