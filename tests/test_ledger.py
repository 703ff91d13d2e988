"""Ledger of landed files, mixed column types, and the order in which releases become visible."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from statweave.sources import files, landing, store
from statweave.streaming import ledger

FOLDERS = {"tipo": "string", "competencia": "int"}


def release(spark, *rows):
    return spark.createDataFrame(rows, "tipo string, competencia int, idade string")


@pytest.fixture
def feed(tmp_path):
    return ledger.Feed(str(tmp_path / "pouso"), str(tmp_path / "bronze"), ["idade"], FOLDERS, max_files=2)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def parts(folder) -> list[Path]:
    return sorted(p for p in Path(folder).rglob("*.parquet") if "/_" not in str(p)[len(str(folder)):])


def test_later_runs_open_new_files_only(spark, feed):
    assert ledger.rows(spark, feed).count() == 0 and ledger.ledger(spark, feed).count() == 0
    landing.land(spark, release(spark, ("FOR", 1, "5"), ("MOV", 1, "6"), ("MOV", 2, "7")), feed.landing)
    assert ledger.ingest(spark, feed) == 3
    sizes = {p.name: p.stat().st_size for p in parts(feed.landing)}
    for path in parts(feed.landing):
        path.write_bytes(b"no longer a Parquet file")  # whoever opens it fails
    assert ledger.ingest(spark, feed) == 0
    since = datetime.now()
    landing.land(spark, release(spark, ("MOV", 3, "8"), ("MOV", 3, "9")), feed.landing)
    assert ledger.ingest(spark, feed) >= 1 and ledger.added(spark, feed, since) == 2
    assert values(ledger.rows(spark, feed).select("tipo", "competencia", "idade")) == [
        ("FOR", 1, "5"), ("MOV", 1, "6"), ("MOV", 2, "7"), ("MOV", 3, "8"), ("MOV", 3, "9")]
    book = ledger.ledger(spark, feed)
    assert {Path(r.arquivo).name: r.tamanho for r in book.where("competencia < 3").collect()} == sizes
    assert values(book.groupBy("tipo", "competencia").sum("linhas", "resgatadas")) == [("FOR", 1, 1, 0), ("MOV", 1, 1, 0), ("MOV", 2, 1, 0), ("MOV", 3, 2, 0)]


def test_one_column_of_several_types_lands_whole(spark, feed):
    kinds = ["string", "int", "bigint", "double", "date", "array<int>"]
    for k, kind in enumerate(kinds):
        value = {"date": "DATE'2020-01-02'", "array<int>": "array(1, 2)"}.get(kind, f"CAST({k} AS {kind})")
        extra = ["TRUE AS nova"] * (k % 2)
        spark.range(1).coalesce(1).selectExpr(f"{value} AS idade", *extra).write.parquet(f"{feed.landing}/tipo=MOV/competencia={k}")
    found = files.schema_groups(spark, [str(p) for p in parts(feed.landing)])
    assert sum(len(some) for _, some in found) == 6 and len(found) == 6
    ledger.ingest(spark, feed)
    assert [tuple(r) for r in ledger.rows(spark, feed).orderBy("competencia").select("competencia", "idade", "_rescued_data").collect()] == [
        (0, "0", None), (1, "1", '{"nova":"true"}'), (2, "2", None), (3, "3.0", '{"nova":"true"}'), (4, "2020-01-02", None), (5, "[1,2]", '{"nova":"true"}')]
    assert ledger.ledger(spark, feed).agg({"resgatadas": "sum"}).first()[0] == 3


def test_groups_of_intermixed_files_are_joined(spark, tmp_path):
    for k in range(6):
        spark.range(1).selectExpr(f"CAST(1 AS {('int', 'string')[k % 2]}) AS a", f"1 AS b{k}").coalesce(1).write.parquet(f"{tmp_path}/{k}")
    found = files.schema_groups(spark, [str(p) for p in parts(tmp_path)])
    assert sorted(len(some) for _, some in found) == [3, 3]
    assert {tuple(f.name for f in kinds) for kinds, _ in found} == {("a", "b0", "b2", "b4"), ("a", "b1", "b3", "b5")}


def test_a_lot_that_breaks_off_is_invisible_and_comes_again(spark, feed, monkeypatch):
    landing.land(spark, release(spark, ("MOV", 1, "6")), feed.landing)
    ledger.ingest(spark, feed)
    landing.land(spark, release(spark, ("MOV", 2, "7"), ("MOV", 2, "8")), feed.landing)
    real = store.move

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(store, "move", broken)
    with pytest.raises(Exception, match="lost"):
        ledger.ingest(spark, feed)
    assert ledger.rows(spark, feed).count() == 1 and ledger.ledger(spark, feed).count() == 1
    monkeypatch.setattr(store, "move", real)
    ledger.ingest(spark, feed)
    assert values(ledger.rows(spark, feed).select("competencia", "idade")) == [(1, "6"), (2, "7"), (2, "8")]


def test_folder_and_file_column_of_one_name_stop_the_run(spark, feed):
    spark.range(1).selectExpr("'5' AS idade", "'X' AS tipo").write.parquet(f"{feed.landing}/tipo=MOV/competencia=1")
    with pytest.raises(Exception, match="both in folder names and in files"):
        ledger.ingest(spark, feed)


ROWS = [(kind, month, f"{kind}{month}{k}") for month in (202512, 202601, 202602) for kind in ("MOV", "FOR", "EXC") for k in range(2)][:-2]
STEPS = [(kind, month) for month in (202512, 202601, 202602) for kind in ("FOR", "EXC", "MOV")]
STEPS.remove(("EXC", 202602))


@pytest.mark.parametrize("step", range(len(STEPS)))
def test_a_load_that_breaks_off_is_taken_up_again(spark, tmp_path, monkeypatch, step):
    published, path, done = release(spark, *ROWS), str(tmp_path / "pouso"), []
    real = landing._publish

    def breaking(spark_, staging, target, kind, period):
        if len(done) == step:
            raise OSError("lost")
        real(spark_, staging, target, kind, period)
        done.append((kind, period))

    monkeypatch.setattr(landing, "_publish", breaking)
    with pytest.raises(OSError):
        landing.land(spark, published, path)
    monkeypatch.setattr(landing, "_publish", real)
    landed = landing.landed_releases(spark, path)
    there = set() if landed is None else set(map(tuple, landed.collect()))
    assert there == set(STEPS[:step])
    complete = max((m for k, m in there if k == "MOV"), default=0)
    if landed is not None:
        assert set(map(tuple, landing.missing_periods(published, landed).select("tipo", "competencia").collect())) == {
            (k, m) for k, m in STEPS[step:] if m > complete}
    assert landing.land(spark, published, path) == len(STEPS) - step
    assert values(files.scan_partitioned(spark, path).select("tipo", "competencia", "idade")) == sorted(ROWS, key=repr)
    assert landing.land(spark, published, path) == 0 and not store.exists(spark, f"{path}/{landing.STAGING}")


def test_a_bounded_load_takes_the_first_releases(spark, tmp_path):
    path = str(tmp_path / "pouso")
    for most, there in ((2, 2), (0, 2), (3, 5), (100, 8)):
        landing.land(spark, release(spark, *ROWS), path, most=most)
        assert set(map(tuple, landing.landed_releases(spark, path).collect())) == set(STEPS[:there])


def test_checks_are_measured_lot_by_lot(spark, feed):
    checked = replace(feed, max_files=1000, typed=lambda raw: raw.withColumn("anos", F.col("idade").try_cast("int")),
                      checks={"lida": F.col("anos").isNotNull(), "adulta": F.col("anos") >= 18})
    assert ledger.quality_history(spark, checked).count() == 0
    for rows in ([("MOV", 1, "20"), ("MOV", 1, "x"), ("MOV", 1, None)], [("MOV", 2, "17")]):
        landing.land(spark, release(spark, *rows), checked.landing)
        ledger.ingest(spark, checked)
    assert values(ledger.quality_history(spark, checked).select("_lote", "expectativa", "linhas", "violacoes")) == [
        (0, "adulta", 3, 2), (0, "lida", 3, 2), (1, "adulta", 1, 1), (1, "lida", 1, 0)]
    assert ledger.rows(spark, checked).count() == 4
