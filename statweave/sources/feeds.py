"""Driver tables seen as the three kinds of raw feed.

Each feed is one flat projection of one large table, so no feed needs a join: a
scan reads only the columns a query asks for. Feeds are all text, as landed, and
carry the quirks the typing rules must survive (padding, decimal commas, zeros
for "not reported", unknown codes, blanks and NULLs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import rulebook as R
from .literals import literal_table

# Codes 0..18 of the nation table are the region of interest, 19..24 lie outside it.
REGION_SIZE = 19
CORE_CODE = "23"

# 1998 has no reference wage on purpose: it exercises the missing-year rule.
FEED_WAGES = {1995: 10000.0, 1996: 10500.0, 1997: 11000.0, 1999: 12000.0, 2000: 12500.0, 2001: 13000.0}

SECTIONS = "ABCDEFGHIJKLMNOPQRSTUZ"
EDUCATION = {
    "1": "Analfabeto",
    "2": "Até 5ª Incompleto",
    "3": "5ª Completo Fundamental",
    "4": "6ª a 9ª Fundamental",
    "5": "Fundamental Completo",
    "6": "Médio Incompleto",
    "7": "Médio Completo",
    "8": "Superior Incompleto",
    "9": "Superior Completo",
    "10": "Mestrado",
    "11": "Doutorado",
    "80": "Pós-Graduação completa",
}

# Deflators of three quarters; the second quarter has none on purpose.
DEFLATORS = [(2024, 1, 1.5, 1.25), (2024, 3, 1.25, 1.125), (2024, 4, 1.0, 1.0)]

FLOW_RELEASE = "CAST(floor((mes + defasagem) / CAST(12 AS DOUBLE)) * 100 + (mes + defasagem) % 12 + 1 AS INT)"
FLOW_TEXT = """
SELECT tipo,
       {release} AS competencia,
       CAST(ano * 100 + mes % 12 + 1 AS STRING) AS competenciamov,
       CAST(ano * 100 + mes % 12 + 1 AS STRING) AS competenciadec,
       CASE WHEN tipo = 'EXC'
            THEN CAST({release} AS STRING)
       END AS competenciaexc,
       CASE WHEN tipo = 'EXC' THEN '1' END AS indicadordeexclusao,
       ' ' || CAST(l_suppkey % 25 AS STRING) AS municipio,
       substr('ABCDEFGHIJKLMNOPQRSTUZ', CAST(1 + l_partkey % 22 AS INT), 1) AS secao,
       lpad(CAST(l_partkey % 1301 AS STRING), 7, '0') AS subclasse,
       lpad(CAST((l_partkey % 997) * 1003 AS STRING), 6, '0') AS cbo2002ocupacao,
       CASE l_linestatus WHEN 'O' THEN '1' ELSE '-1' END AS saldomovimentacao,
       CASE WHEN l_orderkey % 17 = 0 THEN '35' ELSE '97' END AS tipomovimentacao,
       CASE l_partkey % 20 WHEN 0 THEN '103' WHEN 1 THEN '999' ELSE '101' END AS categoria,
       CASE l_orderkey % 14 WHEN 12 THEN '80' WHEN 13 THEN '99' WHEN 0 THEN NULL
            ELSE ' ' || CAST(l_orderkey % 14 AS STRING) END AS graudeinstrucao,
       CASE WHEN l_partkey % 51 = 50 THEN NULL ELSE CAST(l_partkey % 51 AS STRING) END AS idade,
       CAST(20 + 4 * (l_linenumber % 7) AS STRING) || ',00' AS horascontratuais,
       CASE l_partkey % 5 WHEN 0 THEN '9' WHEN 1 THEN '1' WHEN 2 THEN '1' ELSE '3' END AS sexo,
       CAST(l_partkey % 7 AS STRING) AS racacor,
       CASE WHEN l_orderkey % 97 = 0 THEN 'n/d'
            WHEN l_orderkey % 89 = 0 THEN '0,00'
            ELSE ' ' || replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '.', ',') END AS salario,
       CASE WHEN l_linenumber = 7 THEN '1' WHEN l_orderkey % 53 = 0 THEN '99' ELSE '5' END AS unidadesalariocodigo,
       CASE WHEN l_linenumber % 7 = 0 THEN '1' ELSE '0' END AS indtrabparcial,
       CASE WHEN l_orderkey % 29 = 0 THEN '1' ELSE '0' END AS indtrabintermitente
"""
FLOW_EVENTS = """SELECT *, CASE l_returnflag WHEN 'N' THEN 'MOV' WHEN 'A' THEN 'FOR' ELSE 'EXC' END AS tipo,
             year(l_shipdate) AS ano,
             year(l_shipdate) * 12 + month(l_shipdate) - 1 AS mes,
             CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 + l_linenumber % 3 END AS defasagem
      FROM {lineitem}"""
FLOW_SQL = FLOW_TEXT.replace("{release}", FLOW_RELEASE) + f"FROM ({FLOW_EVENTS}) AS eventos\n"

STOCK_SQL = """
SELECT CAST(year(o_orderdate) AS INT) AS ano_base,
       ' ' || CAST(o_custkey % 25 AS STRING) AS municipio_codigo,
       CASE WHEN o_orderstatus = 'F' THEN '0' ELSE '1' END AS ind_vinculo_ativo_31_12_codigo,
       CASE o_orderpriority WHEN '1-URGENT' THEN '30' ELSE ' 10' END AS tipo_vinculo_codigo,
       CAST(1 + o_orderkey % 9 AS STRING) AS tipo_admissao_trabalhador_codigo,
       CASE WHEN o_orderkey % 4 = 0 THEN lpad(CAST(month(o_orderdate) AS STRING), 2, '0') ELSE '00' END
           AS mes_admissao_codigo,
       CASE WHEN o_orderstatus = 'F' THEN CAST(1 + o_orderkey % 12 AS STRING) ELSE '0' END
           AS mes_desligamento_codigo,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '21' ELSE '11' END
           AS motivo_desligamento_codigo,
       '101' AS categoria_trabalhador_codigo,
       ' ' || CAST(10000 + (o_custkey % 66) * 10 AS STRING) AS cnae_2_0_classe_codigo,
       CAST((10000 + (o_custkey % 66) * 10) * 100 + o_custkey % 3 AS STRING) AS cnae_2_0_subclasse_codigo,
       CASE WHEN o_custkey % 26 = 23 THEN '1015' WHEN o_custkey % 7 = 0 THEN '3999' ELSE '2062' END
           AS natureza_juridica_codigo,
       CAST(1 + o_custkey % 26 AS STRING) AS ibge_subsetor_codigo,
       CAST(1 + o_orderkey % 11 AS STRING) AS tamanho_estabelecimento_codigo,
       CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE '0' END AS ind_estabelecimento_participante_simples_codigo,
       ' ' || lpad(CAST((o_orderkey % 997) * 1003 AS STRING), 6, '0') AS cbo_2002_ocupacao_codigo,
       CASE WHEN o_orderkey % 21 = 20 THEN '9' WHEN o_orderkey % 5 < 2 THEN '1' ELSE '2' END AS sexo_codigo,
       CASE o_custkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '4' WHEN 3 THEN '6' WHEN 4 THEN '8'
            ELSE '99' END AS raca_cor_codigo,
       CASE WHEN o_orderkey % 12 = 0 THEN '-1' ELSE ' ' || CAST(o_orderkey % 12 AS STRING) END
           AS escolaridade_apos_2005_codigo,
       CAST(o_orderkey % 67 AS STRING) AS idade,
       CASE WHEN o_orderkey % 31 = 0 THEN '1' ELSE '0' END AS ind_portador_defic_codigo,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS STRING) END AS qtd_hora_contr,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 240 AS STRING) || '.5' END AS tempo_emprego,
       CASE WHEN o_orderkey % 10 = 0 THEN '.00'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS vl_rem_media_nom,
       CASE WHEN o_orderkey % 9 = 0 THEN '.00'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 100 AS STRING) END AS vl_rem_dezembro_nom,
       '999997' AS bairros_fortaleza_codigo,
       CASE WHEN o_orderkey % 500 = 3 THEN CAST(o_custkey % 25 AS STRING) ELSE '999999' END AS municipio_trab_codigo
FROM {orders}
"""

SURVEY_SQL = """
SELECT CAST(year(ts) AS STRING) AS ano,
       CAST(1 + (day(ts) - 1) % 4 AS STRING) AS trimestre,
       '23' AS uf,
       CASE WHEN user_id % 3 = 0 THEN '23' ELSE '' END AS capital,
       CASE WHEN user_id % 50 = 49 THEN '' ELSE '23' END AS rm_ride,
       lpad(CAST(CAST(value AS DECIMAL(18,2)) AS STRING), 12, '0') AS peso,
       CAST(1 + user_id % 2 AS STRING) AS sexo,
       CASE WHEN user_id % 10 = 9 THEN '9' ELSE CAST(1 + user_id % 5 AS STRING) END AS cor_raca,
       lpad(CAST((user_id * 7) % 90 AS STRING), 3, '0') AS idade,
       CAST(1 + user_id % 7 AS STRING) AS nivel_instrucao,
       CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN '2' ELSE '1' END AS condicao_forca_trabalho,
       CASE event_type WHEN 'view' THEN '2' WHEN 'click' THEN '1' WHEN 'purchase' THEN '1' ELSE NULL END
           AS condicao_ocupacao,
       CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN '1' ELSE NULL END AS forca_trabalho_potencial,
       CASE WHEN event_type IN ('click', 'purchase') AND event_id % 5 = 0 THEN '1' ELSE NULL END AS subocupacao,
       CASE WHEN event_type = 'error' AND event_id % 8 = 0 THEN '1' ELSE NULL END AS desalento,
       CASE WHEN event_type IN ('click', 'purchase') THEN lpad(CAST(1 + event_id % 10 AS STRING), 2, '0')
            ELSE NULL END AS posicao_categoria,
       CASE WHEN event_type IN ('click', 'purchase') THEN lpad(CAST(1 + event_id % 12 AS STRING), 2, '0')
            ELSE NULL END AS grupamento_atividade,
       CASE WHEN event_type IN ('click', 'purchase') THEN lpad(CAST(1 + event_id % 11 AS STRING), 2, '0')
            ELSE NULL END AS grupamento_ocupacional,
       CASE WHEN event_type IN ('click', 'purchase') THEN CASE WHEN event_id % 3 = 0 THEN '2' ELSE '1' END
            ELSE NULL END AS contribuicao_previdenciaria,
       CASE WHEN event_type = 'purchase' OR (event_type = 'click' AND event_id % 2 = 0)
            THEN lpad(CAST(event_id % 5000 AS STRING), 8, '0') ELSE NULL END AS rendimento_habitual,
       CASE WHEN event_type = 'purchase' THEN lpad(CAST(event_id % 4000 AS STRING), 8, '0') ELSE NULL END
           AS rendimento_efetivo,
       CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE NULL END AS negocio_cnpj
FROM {events}
"""


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flow_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLOW_SQL, lineitem=driver_table(spark, sf_dir, "lineitem"))


def flow_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rows of ``flow_raw`` are made of, beside their release: a quarter of the text's width."""
    events = spark.sql(FLOW_EVENTS, lineitem=driver_table(spark, sf_dir, "lineitem"))
    return events.selectExpr("tipo", f"{FLOW_RELEASE} AS competencia", "ano", "mes", "l_orderkey", "l_partkey", "l_suppkey",
                             "l_linenumber", "l_linestatus", "l_extendedprice")


def flow_text(events: DataFrame) -> DataFrame:
    """The rows of ``flow_raw`` from their events."""
    return events.sparkSession.sql(FLOW_TEXT.replace("{release}", "competencia") + "FROM {eventos}", eventos=events)


def stock_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(STOCK_SQL, orders=driver_table(spark, sf_dir, "orders"))


def survey_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SURVEY_SQL, events=driver_table(spark, sf_dir, "events"))


def rules() -> R.Rules:
    """Rules for the driver feeds: area codes of the nation table and made-up wages."""
    return R.Rules(areas={code: f"NATION_{code}" for code in range(REGION_SIZE)}, wages=FEED_WAGES)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region members from the nation table: (municipio_codigo, municipio_nome)."""
    nation = driver_table(spark, sf_dir, "nation")
    return nation.where(nation.n_nationkey < REGION_SIZE).selectExpr(
        "CAST(n_nationkey AS INT) AS municipio_codigo", "n_name AS municipio_nome"
    )


def code_rows() -> list[tuple[str, str, str]]:
    """(domain, code, description); some codes are absent on purpose."""
    sections = [("secao", letter, f"Setor {letter}") for letter in SECTIONS[:-1]]
    education = [("graudeinstrucao", code, text) for code, text in EDUCATION.items()]
    occupations = [
        ("cbo2002ocupacao", str(i * 1003).rjust(6, "0"), f"Ocupação {i}") for i in range(997) if i % 10 != 3
    ]
    return sections + education + occupations


def codes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, code_rows(), "dominio string, codigo string, descricao string")


def class_rows() -> list[tuple[int, str]]:
    """Activity class -> section letter, three classes per section; 3 of 66 classes have none."""
    return [(10000 + 10 * j, SECTIONS[j // 3]) for j in range(63)]


def classes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, class_rows(), "cnae_classe int, cnae_secao string")


def deflators(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, DEFLATORS, "ano int, trimestre int, deflator_habitual double, deflator_efetivo double"
    )


def firm_sizes(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        R.firm_size_rows(),
        "ibge_subsetor_codigo int, tamanho_estabelecimento_codigo int, porte string",
    )


def wages(spark: SparkSession) -> DataFrame:
    return literal_table(spark, sorted(FEED_WAGES.items()), "ano int, valor double")
