"""The whole refresh over a small landing area, and the published questions as SQL on its tables."""

from __future__ import annotations

import json
import re

import pytest

from statweave.plans import gold, pipeline
from statweave.plans.lake import Lake
from statweave.sources import feeds, files

YEARS = "ano_base >= 2000"


@pytest.fixture(scope="module")
def refreshed(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("lago")
    lake, landed = Lake(spark, sf_dir), root / "raw"
    for name in ("silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        spark.sql(f"CREATE DATABASE {name} LOCATION '{root / name}'")
    events = lake.flow_raw.where("competencia >= 200012")
    files.write_partitioned(events, f"{landed}/caged", "tipo", "competencia")
    declared = pipeline.SOURCES["rais_vinculo"].columns
    files.write_partitioned(lake.stock_raw.where(YEARS).select("ano_base", *declared), f"{landed}/rais", "ano_base")
    wide = pipeline.SOURCES["rais_ceara_vinculo"].columns
    files.write_partitioned(lake.stock_raw.where(YEARS).select("ano_base", *wide), f"{landed}/rais_ceara", "ano_base")
    lake.survey_raw.selectExpr("*", "'nova' AS coluna_nova").write.parquet(f"{landed}/pnad/ano=2024/trimestre=9")
    reference = landed / "referencia"
    reference.mkdir(parents=True)
    for domain in ("secao", "graudeinstrucao", "cbo2002ocupacao"):
        lines = [f"{code.lstrip('0') or '0'},{text}" for d, code, text in feeds.code_rows() if d == domain]
        (reference / f"caged_{domain}.csv").write_text("\n".join(["codigo,descricao", *lines]), encoding="utf-8")
    crosswalk = {str(code): section for code, section in feeds.class_rows()}
    (reference / "cnae_classe_secao.json").write_text(json.dumps(crosswalk), encoding="utf-8")
    header = "ano,trimestre,deflator_habitual,deflator_efetivo"
    lines = [",".join(map(str, row)) for row in feeds.DEFLATORS]
    (reference / "pnad_deflator_ceara.csv").write_text("\n".join([header, *lines]), encoding="utf-8")
    run = lambda: pipeline.refresh(spark, str(landed), str(root / "bronze"), feeds.rules())
    run()
    tables, report = run()  # a second run finds no new file and must change nothing
    yield lake, tables, {(r.tabela, r.expectativa): (r.linhas, r.violacoes) for r in report.collect()}
    for name in ("silver", "gold"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_ten_tables_with_published_columns(spark, refreshed):
    _, tables, _ = refreshed
    assert set(tables) == set(gold.TABLES) and len(tables) == 10
    for name, columns in gold.TABLES.items():
        saved = spark.table(f"gold.{name}")
        assert saved.dtypes == [(column, kind) for column, (kind, _) in columns.items()]
        assert all(saved.schema[column].metadata.get("comment") for column in columns)
        assert saved.count() > 0


def test_tables_equal_the_lazy_layers(refreshed):
    lake, tables, _ = refreshed
    for name, df in {"caged_fluxo": lake.flow(), "pnad_indicadores": lake.rates(),
                     "rais_estoque": lake.stock().where(YEARS)}.items():
        ours = tables[name].drop("soma_horas_mes")
        assert ours.exceptAll(gold.published(df, name).drop("soma_horas_mes")).count() == 0
        assert ours.count() == df.count()


def test_quality_report(refreshed):
    lake, _, report = refreshed
    people = lake.survey_raw.count()
    assert report["pnad_pessoa", "sem_dados_resgatados"] == (people, people)  # the column nobody declared
    assert report["caged_movimentacao", "sem_dados_resgatados"][1] == 0
    assert report["caged_movimentacao", "efeito_valido"][1] == 0
    assert report["caged_fluxo", "saldo_consistente"][1] == 0
    assert report["pnad_mercado_trabalho", "ocupados_mais_desocupados_igual_forca"][1] == 0


QUESTIONS = [
    """SELECT municipio_nome, SUM(saldo) AS saldo_jovens FROM gold.caged_fluxo
       WHERE faixa_etaria IN ('15-17', '18-24', '25-29') GROUP BY municipio_nome ORDER BY saldo_jovens DESC""",
    """SELECT competencia_mov, preliminar, SUM(saldo) AS saldo FROM gold.caged_fluxo
       GROUP BY competencia_mov, preliminar ORDER BY competencia_mov""",
    """SELECT salario_mediano, admissoes_com_salario FROM gold.caged_salario_mediano
       WHERE periodo = 'Últimos 12 meses' AND municipio_nome = 'Todos' AND faixa_etaria = '18-24' AND sexo = 'Todos'
         AND cnae_secao_descricao = 'Todos'""",
    """SELECT ano, trimestre, taxa_desocupacao_pct, amostra_suficiente FROM gold.pnad_indicadores
       WHERE recorte = 'RMF' AND sexo = 'Todos' AND publico = 'Jovens (15 a 29 anos)'
         AND ano * 10 + trimestre = (SELECT MAX(ano * 10 + trimestre) FROM gold.pnad_indicadores)""",
    """SELECT porte_oficial, SUM(vinculos) AS empregos,
              ROUND(SUM(soma_rem_dezembro) / SUM(n_rem_dezembro), 2) AS salario_medio
       FROM gold.rais_estoque GROUP BY porte_oficial ORDER BY empregos DESC""",
]


@pytest.mark.parametrize("sql", QUESTIONS)
def test_questions_run_on_the_tables(spark, refreshed, sql):
    assert spark.sql(sql).count() > 0


def test_tables_are_read_by_their_months(spark, refreshed):
    newest = spark.sql("SELECT max(competencia_mov) FROM gold.caged_fluxo").first()[0]
    for table in ("silver.caged_movimentacao", "gold.caged_fluxo", "gold.caged_ocupacoes"):
        some = spark.table(table).where(f"competencia_mov > {newest - 1}")
        assert re.search(r"PartitionFilters: \[[^\]]*competencia_mov", some._jdf.queryExecution().executedPlan().toString())
        assert {name.split("competencia_mov=")[1].split("/")[0] for name in some.select("municipio_codigo").inputFiles()} >= {str(newest)}
        scan = some.groupBy("competencia_mov").count()
        scan.collect()
        assert scan.count() == 1 < spark.table(table).select("competencia_mov").distinct().count()


def test_readers_keep_the_version_they_started_with(spark, refreshed):
    held = spark.table("gold.pnad_indicadores")
    rows = sorted(map(str, held.collect()))
    pipeline._save(held.limit(1), "gold.pnad_indicadores")
    assert sorted(map(str, held.collect())) == rows and spark.table("gold.pnad_indicadores").count() == 1
    pipeline._save(held, "gold.pnad_indicadores")
    assert sorted(map(str, spark.table("gold.pnad_indicadores").collect())) == rows
    assert all(f.metadata.get("comment") for f in spark.table("gold.pnad_indicadores").schema)
