"""Scans, sinks and incremental ingestion."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import types as T

from statweave import rulebook as R
from statweave.sources import feeds, files, landing, scratch
from statweave.sources.literals import literal_table
from statweave.streaming import ingest

RELEASE = "tipo string, competencia int, municipio string"


def release(spark, *rows):
    return spark.createDataFrame(rows, RELEASE)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name, expected", [
    ("Município - Código", "municipio_codigo"), ("seção", "secao"), ("  UF  ", "uf"),
    ("Ind Vínculo Ativo 31/12 - Código", "ind_vinculo_ativo_31_12_codigo"), ("ano_base", "ano_base")])
def test_snake(name, expected):
    assert files.snake(name) == expected


def test_each_file_is_ingested_once(spark, tmp_path):
    source, target, control = (str(tmp_path / n) for n in ("pouso", "bronze", "controle"))
    schema = files.text_schema(["municipio"], tipo="string", competencia="int")

    def load():
        since = datetime.now()
        # One file a batch: more batches than a query remembers the progress of would be counted too.
        ingest.ingest_available(ingest.landing_stream(spark, source, schema, max_files=1), target, control)
        return ingest.added_rows(spark.read.parquet(target), since)

    landing.land(spark, release(spark, ("MOV", 202601, "1"), ("FOR", 202601, "2")), source)
    assert load() == 2 and load() == 0
    landing.land(spark, release(spark, ("MOV", 202601, "9"), ("EXC", 202602, "3"), ("MOV", 202602, "4")), source)
    assert load() == 2
    bronze = spark.read.parquet(target)
    assert rows_of(bronze.select("tipo", "competencia", "municipio")) == [
        ("EXC", 202602, "3"), ("FOR", 202601, "2"), ("MOV", 202601, "1"), ("MOV", 202602, "4")]
    audit = bronze.where("tipo = 'EXC'").first()
    assert "tipo=EXC/competencia=202602" in audit._arquivo_origem and audit._ingerido_em is not None


def test_landing_skips_releases_that_are_there(spark, tmp_path):
    path = str(tmp_path / "pouso")
    assert landing.landed_releases(spark, path) is None
    landing.land(spark, release(spark, ("MOV", 202601, "1")), path)
    landing.land(spark, release(spark, ("MOV", 202601, "2"), ("FOR", 202601, "3")), path)
    assert rows_of(files.scan_partitioned(spark, path).select("tipo", "municipio")) == [("FOR", "3"), ("MOV", "1")]


def test_missing_periods(spark):
    published = landing.releases(release(spark, *[(k, m, "") for k in landing.COMMIT_ORDER for m in (202601, 202602)]))
    landed = landing.releases(release(spark, ("FOR", 202601, ""), ("EXC", 202601, ""), ("MOV", 202601, ""), ("FOR", 202602, "")))
    # A release without its on-time file is incomplete, so the rest of it is still missing.
    assert rows_of(landing.missing_periods(published, landed)) == [("EXC", 202602), ("MOV", 202602)]
    assert landing.missing_periods(published, landed.where("1 = 0"), floor=202601).count() == 3


def test_load_summary(spark):
    published = release(spark, ("MOV", 202601, "a"), ("MOV", 202601, "b"), ("FOR", 202602, "c"))
    summary = landing.load_summary(published, landing.releases(release(spark, ("FOR", 202602, ""))))
    assert rows_of(summary) == [(202601, "MOV", 2, "carregado"), (202602, "FOR", None, "já existia")]
    assert landing.new_periods(summary).first()[0] == 1


def test_rescue_keeps_what_does_not_fit(spark):
    wide = spark.createDataFrame([("7", "x", None), ("sete", "y", None), (None, "z", "extra")],
                                 "idade string, nome string, novo string")
    fitted = files.rescue(wide, T.StructType.fromDDL("idade int, nome string, ausente double"))
    assert fitted.columns == ["idade", "nome", "ausente", "_rescued_data"]
    assert rows_of(fitted) == rows_of(spark.createDataFrame(
        [(7, "x", None, None), (None, "y", None, '{"idade":"sete"}'), (None, "z", None, '{"novo":"extra"}')],
        fitted.schema))


def test_rescue_reads_columns_of_every_file(spark, tmp_path):
    path = str(tmp_path / "misto")
    spark.createDataFrame([("1",)], "a string").write.parquet(path)
    spark.createDataFrame([("2", "b")], "a string, extra string").write.mode("append").parquet(path)
    scanned = files.scan_rescued(spark, path, T.StructType.fromDDL("a int"))
    assert rows_of(scanned) == [(1, None), (2, '{"extra":"b"}')]


def test_folder_values_hide_file_values_unless_ignored(spark, tmp_path):
    path = str(tmp_path / "pnad")
    spark.createDataFrame([("2025", "1")], "ano string, peso string").write.parquet(f"{path}/ano=2030")
    assert files.folder_clash(spark, path) == ["ano"]
    assert files.scan_partitioned(spark, path).first().ano == 2030
    assert files.scan_ignoring_folders(spark, path).first().ano == "2025"


def test_latin1_round_trip(spark, tmp_path):
    names = ["Município - Código", "Descrição"]
    df = spark.createDataFrame([("230440", "São Gonçalo, \"centro\""), ("999", "fora")], "a string, b string").toDF(*names)
    path = files.write_delimited(df, str(tmp_path / "csv"), ",", "ISO-8859-1")
    scanned = files.region_filter(files.scan_delimited(spark, path, names, ",", "ISO-8859-1"), names[0], R.REGION_AREAS)
    assert rows_of(files.snake_columns(scanned)) == [("230440", 'São Gonçalo, "centro"')]


def test_fixed_width_inverse(spark):
    layout = {"uf": (5, 7), "ano": (0, 4), "peso": (9, 15)}
    df = spark.createDataFrame([("23", "2026", "1.5"), (None, "2025", "000002")], "uf string, ano string, peso string")
    lines = df.select(files.fixed_width_line(layout).alias("value"))
    assert {len(r.value) for r in lines.collect()} == {15}
    assert rows_of(files.fixed_width(lines, layout)) == [("23", "2026", "1.5"), (None, "2025", "000002")]


def test_survey_layout_has_no_overlap():
    spans = sorted(R.SURVEY_LAYOUT.values())
    assert len(spans) == 22 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_dictionary_files(spark, tmp_path):
    for domain, text in {"sexo": "codigo,descricao\n1,Homem\n", "cbo2002ocupacao":
                         "codigo,descricao\n10105,Oficial\n5211100,Longo\n"}.items():
        (tmp_path / f"caged_{domain}.csv").write_text(text, encoding="utf-8")
    table = files.dim_from_filenames(spark, f"{tmp_path}/caged_*.csv", "caged_", {"cbo2002ocupacao": 6})
    # Padding restores a lost zero and never cuts a code that is too long.
    assert rows_of(table) == [("cbo2002ocupacao", "010105", "Oficial"), ("cbo2002ocupacao", "5211100", "Longo"),
                              ("sexo", "1", "Homem")]


def test_json_map(spark, tmp_path):
    (tmp_path / "mapa.json").write_text('{"01113": "A",\n "64212": "K"}', encoding="utf-8")
    assert rows_of(files.dim_from_json_map(spark, str(tmp_path / "mapa.json"), "classe", "secao")) == [
        (1113, "A"), (64212, "K")]


def test_rewriting_a_folder_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "sink")
    df = release(spark, ("MOV", 1, "a"), ("FOR", 1, "b"))
    files.write_partitioned(df, path, "tipo", "competencia")
    files.write_partitioned(release(spark, ("MOV", 1, "c")), path, "tipo", "competencia")
    assert rows_of(files.scan_partitioned(spark, path).select("tipo", "municipio")) == [("FOR", "b"), ("MOV", "c")]


def test_comments_survive_saving(spark, tmp_path):
    df = files.with_comments(spark.range(1).toDF("n"), {"n": "How many."})
    df.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["n"].metadata == {"comment": "How many."}


def test_prefix_scan_reads_three_columns(spark, tmp_path):
    df = spark.createDataFrame([("2304", "1", "x", "y"), ("3300", "1", "x", "y")], "a string, b string, c string, d string")
    df.write.parquet(str(tmp_path / "t"))
    cut = files.scan_prefix(spark.read.parquet(str(tmp_path / "t")), "a", "23", ["a", "b"])
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert cut.count() == 1 and "StringStartsWith(a,23)" in plan and "ReadSchema: struct<a:string,b:string>" in plan


def test_literal_table_has_a_known_size(spark):
    table = literal_table(spark, [(1, None), (2, "x")], "k int, v string")
    assert table.dtypes == [("k", "int"), ("v", "string")] and rows_of(table) == [(1, None), (2, "x")]
    assert table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000
    assert literal_table(spark, [], "k int, v string").count() == 0


def test_scratch_paths_lie_in_the_shared_folder(spark):
    first, second = scratch.scratch_path(spark, "a"), scratch.scratch_path(spark, "a")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([(2,)], "n int")
    assert rows_of(files.union_by_name(a, b)) == [(1, "x"), (2, None)]


def test_query_files(spark, tmp_path):
    files.write_partitioned(release(spark, ("MOV", 1, "a"), ("MOV", 1, "b")), str(tmp_path / "t"), "tipo", "competencia")
    found = files.query_files(spark, str(tmp_path / "t"), "SELECT tipo, COUNT(*) AS n FROM {files} GROUP BY ALL")
    assert rows_of(found) == [("MOV", 2)]


def test_columns_are_found_by_header(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("descricao;extra;codigo\nComércio;x;G\n", encoding="utf-8")
    assert rows_of(files.scan_delimited(spark, str(path), ["codigo", "descricao"])) == [("G", "Comércio")]
    with pytest.raises(ValueError, match="no column secao"):
        files.scan_delimited(spark, str(path), ["codigo", "secao"])
    path.write_text("deflator,ano\n1.5,2025\nx,2026\n")
    assert rows_of(files.dim_typed_csv(spark, str(path), "ano int, deflator double")) == [(2025, 1.5), (2026, None)]


def test_fixed_width_encoding_and_wide_values(spark, tmp_path):
    path = tmp_path / "latin.txt"
    path.write_bytes("AÇÃO12345\n".encode("latin-1"))
    layout = {"nome": (0, 4), "numero": (4, 9)}
    assert rows_of(files.scan_fixed_width(spark, str(path), layout, "ISO-8859-1")) == [("AÇÃO", "12345")]
    wide = spark.createDataFrame([("AÇÃO!", "1")], "nome string, numero string").select(files.fixed_width_line(layout).alias("value"))
    with pytest.raises(Exception, match="wider than 4"):
        wide.collect()


def test_folder_clash_in_any_file(spark, tmp_path):
    path = str(tmp_path / "deep")
    spark.range(1).write.parquet(f"{path}/mes=1")
    spark.range(1).selectExpr("id", "1 AS mes").write.parquet(f"{path}/mes=2")
    assert files.folder_clash(spark, path) == ["mes"]


def test_a_period_without_its_on_time_file_is_not_missing(spark):
    published = spark.createDataFrame([("MOV", 202601), ("FOR", 202601), ("FOR", 202602), ("EXC", 202603)], landing.RELEASE_SCHEMA)
    landed = spark.createDataFrame([("MOV", 202512)], landing.RELEASE_SCHEMA)
    assert sorted(rows_of(landing.missing_periods(published, landed))) == [("FOR", 202601), ("MOV", 202601)]


def test_landed_text_is_made_after_events_are_dealt(spark, sf_dir, tmp_path):
    """What is moved between tasks is the events, a few numbers; the files have the same rows as the feed."""
    seen = []

    def finish(events):
        seen.append((events.columns, events._jdf.queryExecution().optimizedPlan().toString()))
        return feeds.flow_text(events)

    feed, path = feeds.flow_raw(spark, sf_dir), str(tmp_path / "pouso")
    assert landing.land(spark, feeds.flow_events(spark, sf_dir), path, finish=finish) == landing.releases(feed).count()
    columns, plan = seen[0]
    assert len(columns) == 10 and "RebalancePartitions" in plan and "salario" not in plan
    found = files.scan_partitioned(spark, path).select(*feed.columns)
    assert found.exceptAll(feed).count() == 0 and found.count() == feed.count() > 0
    assert feeds.flow_text(feeds.flow_events(spark, sf_dir)).schema.simpleString() == feed.schema.simpleString()
