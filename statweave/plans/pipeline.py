"""The whole refresh: landed files -> bronze -> silver -> gold tables, with measured quality."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import rulebook as R
from ..operators.cleanse import cleanse
from ..operators import flow, inequality, specialization, stock, survey
from ..session import tuned
from ..sources import files, store
from ..sources.literals import literal_table
from ..streaming import ledger
from . import gold, maintained, silver

@dataclass(frozen=True)
class Source:
    """A landed feed: its folder, the columns of its files, the typed folder columns."""

    folder: str
    columns: tuple[str, ...]
    folders: Mapping[str, str]


# --- fixed values: layout of the landing area --------------------------------------
SOURCES = {
    "caged_movimentacao": Source(
        "caged",
        ("competenciamov", "competenciadec", "competenciaexc", "indicadordeexclusao", "municipio", "secao",
         "subclasse", "cbo2002ocupacao", "saldomovimentacao", "tipomovimentacao", "categoria", "sexo", "racacor",
         "graudeinstrucao", "idade", "horascontratuais", "salario", "unidadesalariocodigo", "indtrabparcial",
         "indtrabintermitente"),
        {"tipo": "string", "competencia": "int"},
    ),
    "rais_vinculo": Source(
        "rais",
        ("municipio_codigo", "ind_vinculo_ativo_31_12_codigo", "tipo_vinculo_codigo",
         "tipo_admissao_trabalhador_codigo", "mes_admissao_codigo", "mes_desligamento_codigo",
         "motivo_desligamento_codigo", "categoria_trabalhador_codigo", "cnae_2_0_classe_codigo",
         "cnae_2_0_subclasse_codigo", "natureza_juridica_codigo", "ibge_subsetor_codigo",
         "tamanho_estabelecimento_codigo", "ind_estabelecimento_participante_simples_codigo",
         "cbo_2002_ocupacao_codigo", "sexo_codigo", "raca_cor_codigo", "escolaridade_apos_2005_codigo", "idade",
         "ind_portador_defic_codigo", "qtd_hora_contr", "tempo_emprego", "vl_rem_media_nom", "vl_rem_dezembro_nom"),
        {"ano_base": "int"},
    ),
    "rais_ceara_vinculo": Source(
        "rais_ceara",
        ("municipio_codigo", "ind_vinculo_ativo_31_12_codigo", "cnae_2_0_classe_codigo"),
        {"ano_base": "int"},
    ),
    # Year and quarter are columns of the files; the folders that repeat them are ignored.
    "pnad_pessoa": Source("pnad", tuple(R.SURVEY_LAYOUT), {}),
}
DICTIONARIES = "referencia/caged_*.csv"
CROSSWALK = "referencia/cnae_classe_secao.json"
DEFLATORS = "referencia/pnad_deflator_ceara.csv"


def feed(landing: str, bronze: str, source: str, rules: R.Rules | None = None) -> ledger.Feed:
    """A feed; with ``rules``, what its rows are expected to keep is measured lot by lot."""
    spec, rules = SOURCES[source], rules or R.Rules()
    typed, checks = {
        "caged_movimentacao": (lambda raw: cleanse(raw, *silver.flow_rules(rules)), silver.flow_checks(rules)),
        "pnad_pessoa": (lambda raw: cleanse(raw, *silver.survey_rules(rules)), silver.survey_checks()),
        "rais_vinculo": (lambda raw: cleanse(raw, *silver.stock_rules(rules)), (silver.stock_checks(rules)[0], {})),
    }.get(source, (None, ({}, {})))
    return ledger.Feed(f"{landing}/{spec.folder}", f"{bronze}/{source}", spec.columns, spec.folders, typed=typed, checks={**checks[0], **checks[1]})


def ingest_bronze(spark: SparkSession, landing: str, bronze: str, source: str, rules: R.Rules | None = None) -> DataFrame:
    """Append the new files of one feed to its bronze table and return the table.

    Files are read with every column they have, whatever its type, so that a column nobody
    declared shows up in the rescue column instead of disappearing. Only new files are opened.
    A column that is both in folder names and in new files stops the run.
    """
    one = feed(landing, bronze, source, rules)
    ledger.ingest(spark, one)
    return ledger.rows(spark, one)


@dataclass(frozen=True)
class Dimensions:
    areas: DataFrame
    codes: DataFrame
    classes: DataFrame
    sizes: DataFrame
    deflators: DataFrame


def load_dimensions(spark: SparkSession, landing: str, rules: R.Rules) -> Dimensions:
    sizes = "ibge_subsetor_codigo int, tamanho_estabelecimento_codigo int, porte string"
    deflators = "ano int, trimestre int, deflator_habitual double, deflator_efetivo double"
    return Dimensions(
        areas=literal_table(spark, sorted(rules.areas.items()), "municipio_codigo int, municipio_nome string"),
        codes=files.dim_from_filenames(spark, f"{landing}/{DICTIONARIES}", "caged_", {"cbo2002ocupacao": 6}),
        classes=files.dim_from_json_map(spark, f"{landing}/{CROSSWALK}", "cnae_classe", "cnae_secao"),
        sizes=literal_table(spark, R.firm_size_rows(), sizes),
        deflators=files.dim_typed_csv(spark, f"{landing}/{DEFLATORS}", deflators),
    )


# Folders of the tables: the period they are asked for by, then what rows are sorted by inside.
LAYOUT = {
    "caged_movimentacao": (["competencia_mov"], ["municipio_codigo"]),
    "rais_vinculo": (["ano_base"], ["municipio_codigo"]),
    "pnad_pessoa": (["ano"], ["trimestre"]),
    "rais_estoque_ceara_secao": (["ano_base"], ["municipio_codigo"]),
    "caged_fluxo": (["competencia_mov"], ["municipio_codigo"]),
    "caged_ocupacoes": (["competencia_mov"], ["municipio_codigo"]),
    "caged_salario_mediano": ([], ["periodo"]),
    "rais_estoque": (["ano_base"], ["municipio_codigo"]),
    "rais_ocupacoes": (["ano_base"], ["municipio_codigo"]),
    "rais_indicadores_municipio": ([], ["ano_base"]),
    "rais_quociente_locacional": ([], ["ano_base"]),
    "pnad_mercado_trabalho": ([], ["ano", "trimestre"]),
    "pnad_indicadores": ([], ["ano", "trimestre"]),
    "pnad_posicao_ocupacao": ([], ["ano", "trimestre"]),
}
VERSIONS_KEPT = 2  # the newest one, and the one that running readers may still have open


def _save(df: DataFrame, table: str) -> DataFrame:
    """Write a new version of a table into a folder of its own, then let the table's name mean that folder.

    Until that step, readers find the version before; nobody sees a part of a table.
    """
    spark, (database, name) = df.sparkSession, table.split(".")
    by, order = LAYOUT[name]
    root = next(r.info_value for r in spark.sql(f"DESCRIBE DATABASE {database}").collect() if r.info_name == "Location")
    versions = f"{root.rstrip('/')}/{name}"
    folder = f"{versions}/{datetime.now(UTC):%Y%m%d%H%M%S%f}"
    dealt = df.hint("rebalance", *[F.col(k) for k in by]) if by else df.hint("rebalance")
    dealt.sortWithinPartitions(*by, *order).write.partitionBy(*by).parquet(folder)
    columns = ", ".join(f"`{f.name}`" + (f" COMMENT {_quoted(f.metadata['comment'])}" if "comment" in f.metadata else "") for f in df.schema)
    values = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in by else f"`{f.name}`" for f in df.schema)
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")  # of the time when tables were written in place
    spark.sql(f"CREATE OR REPLACE VIEW {table} ({columns}) AS SELECT {values} FROM parquet.`{folder}`")
    for old in store.children(spark, versions)[:-VERSIONS_KEPT]:
        store.remove(spark, f"{versions}/{old}")
    return spark.table(table)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def build_silver(
    spark: SparkSession, bronze: Mapping[str, DataFrame], dims: Dimensions, rules: R.Rules, database: str = "silver"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write the typed tables. Also returns (tabela, expectativa, linhas, violacoes), measured while writing."""
    builders = {
        "caged_movimentacao": lambda obs: silver.flow_silver(bronze["caged_movimentacao"], rules, obs),
        "rais_vinculo": lambda obs: silver.stock_silver(bronze["rais_vinculo"], rules, dims.classes, dims.sizes, obs),
        "pnad_pessoa": lambda obs: silver.survey_silver(bronze["pnad_pessoa"], rules, obs),
    }
    tables, report = {}, []
    for name, build in builders.items():
        observation = Observation(name)
        tables[name] = _save(build(observation), f"{database}.{name}")
        counted = dict(observation.get)
        rows = counted.pop("linhas")
        report += [(name, check, rows, broken) for check, broken in counted.items()]
    wide = stock.regional_stock(silver.wide_region(bronze["rais_ceara_vinculo"], rules), dims.classes)
    tables["rais_estoque_ceara_secao"] = _save(wide, f"{database}.rais_estoque_ceara_secao")
    schema = "tabela string, expectativa string, linhas bigint, violacoes bigint"
    return tables, literal_table(spark, report, schema)


def build_gold(
    tables: Mapping[str, DataFrame], dims: Dimensions, rules: R.Rules, database: str = "gold", flow_fact: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write the ten indicator tables, with types and comments as published.

    ``flow_fact`` is the flow fact where it is kept up to date elsewhere.
    """
    events, contracts, people = (tables[n] for n in ("caged_movimentacao", "rais_vinculo", "pnad_pessoa"))
    areas, codes = dims.areas, dims.codes
    saved: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        saved[name] = _save(gold.published(df, name), f"{database}.{name}")
        return saved[name]

    publish("caged_fluxo", flow.flow_by(events, areas, codes, wages=rules.wages) if flow_fact is None else flow_fact)
    publish("caged_ocupacoes", flow.flow_by(events, areas, codes, flow.OCCUPATION_KEYS))
    publish("caged_salario_mediano", flow.median_cube(flow.admission_values(events, areas, codes)))
    publish("rais_estoque", stock.stock_by(contracts, areas, codes, wages=rules.wages))
    publish("rais_ocupacoes", stock.stock_by(
        contracts, areas, codes, stock.OCCUPATION_KEYS, stock.OCCUPATION_MEASURES))
    publish("rais_indicadores_municipio", inequality.inequality_turnover(contracts, areas, rules.region))
    publish("rais_quociente_locacional", specialization.location_quotient(
        tables["rais_estoque_ceara_secao"], areas, codes, rules.region))
    components = publish("pnad_mercado_trabalho", survey.weighted_components(people, dims.deflators))
    publish("pnad_indicadores", survey.survey_rates(components, rules.region))
    publish("pnad_posicao_ocupacao", survey.weighted_by_category(people, rules.region))
    return saved


def refresh(
    spark: SparkSession, landing: str, bronze: str, rules: R.Rules | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """One run: new files in, the tables above brought up to date. Returns gold tables and quality report.

    The flow fact takes in the new lots only; the other tables are recomputed. The databases ``silver`` and ``gold`` must exist.
    """
    rules = rules or R.Rules()
    tuned(spark)
    raw = {name: ingest_bronze(spark, landing, bronze, name, rules) for name in SOURCES}
    dims = load_dimensions(spark, landing, rules)
    tables, quality = build_silver(spark, raw, dims, rules)
    fact = maintained.stored(f"{bronze}/fluxo_por_mes")
    maintained.follow(spark, fact, feed(landing, bronze, "caged_movimentacao", rules), lambda raw: silver.flow_silver(raw, rules), rules.wages)
    published = build_gold(tables, dims, rules, flow_fact=maintained.published(spark, fact, dims.areas, dims.codes))
    report = files.union_by_name(
        quality, gold.constraint_report({name: published[name] for name in gold.CONSTRAINTS})
    )
    return published, report
