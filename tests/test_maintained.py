"""The maintained fact against full recomputes, and versions of a partitioned table."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from statweave.operators import flow
from statweave.plans import catalog, maintained, silver
from statweave.plans.lake import Lake
from statweave.plans.versions import Versions
from statweave.sources import landing, store
from statweave.streaming import ledger


def files_of(folder) -> dict[str, float]:
    return {str(p): p.stat().st_mtime for p in Path(folder).rglob("*.parquet") if "/dados/" in str(p)}


def by_month(index):
    return {member: version for member, version, _ in index}


def test_stored_fact_equals_the_recompute_after_each_landing(spark, sf_dir, tmp_path):
    lake = Lake(spark, sf_dir)
    feed = ledger.Feed(str(tmp_path / "pouso"), str(tmp_path / "bronze"), catalog.FLOW_COLUMNS, catalog.FLOW_FOLDERS)
    fact = maintained.stored(str(tmp_path / "fato"))
    typed = lambda raw: silver.flow_silver(raw, lake.rules)
    assert maintained.published(spark, fact, lake.areas, lake.codes).count() == 0
    # The last releases come last: late and cancelled rows reach back over months.
    count = landing.releases(lake.flow_raw).count()
    for most in (count - 7, 4, 3):
        landing.land(spark, lake.flow_raw, feed.landing, most=most)
        ledger.ingest(spark, feed)
        before, index = files_of(tmp_path / "fato"), by_month(fact.index(spark))
        touched = maintained.follow(spark, fact, feed, typed, lake.rules.wages)
        events = typed(ledger.rows(spark, feed))
        whole = flow.flow_by(events, lake.areas, lake.codes, wages=lake.rules.wages)
        ours = maintained.published(spark, fact, lake.areas, lake.codes)
        assert ours.schema.simpleString() == whole.schema.simpleString()
        assert ours.exceptAll(whole).count() == 0 and ours.count() == whole.count() > 0
        revised = maintained.late_revisions(spark, fact)
        assert revised.exceptAll(flow.late_revisions(events.where(flow.is_month(F.col("competencia_mov"))))).count() == 0
        # Months that were not touched keep their files.
        after = by_month(fact.index(spark))
        assert touched and all(after[m] == v for m, v in index.items() if m not in touched)
        assert all(files_of(tmp_path / "fato")[p] == t for p, t in before.items())
    assert 0 < len(touched) < len(after) / 2
    assert maintained.follow(spark, fact, feed, typed, lake.rules.wages) == []  # nothing new, nothing doubled
    assert maintained.add(spark, fact, maintained.sums_of(events, lake.rules.wages), fact.mark(spark)) == []


def test_window_reads_its_months_only(spark, sf_dir, tmp_path):
    lake = Lake(spark, sf_dir)
    fact = maintained.stored(str(tmp_path / "fato"))
    maintained.add(spark, fact, maintained.sums_of(lake.flow_silver, lake.rules.wages), 0)
    newest = maintained.newest_month(spark, fact)
    inside = [m for m in by_month(fact.index(spark)) if m > flow.months_before(newest, 12)]
    read = fact.read(spark, inside).inputFiles()
    assert {name.split("competencia_mov=")[1][:6] for name in read} == {str(m) for m in inside}
    assert 12 <= len(inside) <= 15 < len(fact.index(spark))
    plan = fact.read(spark).where("competencia_mov = 199805")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(competencia_mov" in plan


@pytest.mark.parametrize("month, back, found", [(202601, 1, 202512), (202612, 12, 202512), (202603, 15, 202412), (202601, 0, 202601)])
def test_months_before(month, back, found):
    assert flow.months_before(month, back) == found


def rows(df):
    return sorted(map(tuple, df.select("k", "v").collect()))


def test_readers_see_whole_versions(spark, tmp_path, monkeypatch):
    table = Versions(str(tmp_path / "t"), "k", "v string")
    make = lambda *r: spark.createDataFrame(r, "v string, k int")
    assert table.read(spark).count() == 0 and table.mark(spark) == -1
    table.publish(spark, make(("a", 1), ("b", 2)), [1, 2], 7)
    held = table.read(spark)  # a reader of the first version
    table.publish(spark, make(("c", 2), ("d", 3)), [2, 3], 8)
    assert rows(held) == [(1, "a"), (2, "b")] and rows(table.read(spark)) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(table.read(spark, [3, 9])) == [(3, "d")] and table.mark(spark) == 8

    def broken(*args):
        raise OSError("lost")

    real = store.move
    monkeypatch.setattr(store, "move", broken)
    with pytest.raises(OSError):
        table.publish(spark, make(("x", 1)), [1], 9)
    monkeypatch.setattr(store, "move", real)
    assert rows(table.read(spark)) == [(1, "a"), (2, "c"), (3, "d")] and table.mark(spark) == 8
    table.publish(spark, make(("y", 2)), [1, 2], 9)  # member 1 has no rows any more
    assert rows(table.read(spark)) == [(2, "y"), (3, "d")]


def test_sums_of_new_months_are_dealt_once(spark, sf_dir, tmp_path, monkeypatch):
    """Events are moved once; only months that are stored already are brought together with their sums."""
    lake = Lake(spark, sf_dir)
    fact, plans, real = maintained.stored(str(tmp_path / "fato")), [], Versions.publish

    def publish(self, spark_, df, members, mark):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        real(self, spark_, df, members, mark)

    monkeypatch.setattr(Versions, "publish", publish)
    month, whole = F.col("competencia_mov"), maintained.sums_of(lake.flow_silver, lake.rules.wages)
    for mark, some in enumerate((month < 199601, month.between(199512, 199712), month > 199712)):
        maintained.add(spark, fact, maintained.sums_of(lake.flow_silver.where(some), lake.rules.wages), mark)
    assert plans[0] == plans[2] == 1 < plans[1]
    last = maintained.sums_of(lake.flow_silver.where(month == 199512), lake.rules.wages)
    twice = whole.unionByName(last).groupBy(*maintained.CODES).agg(*[F.sum(s).alias(s) for s in maintained.SUMS])
    ours = fact.read(spark).select(*twice.columns)
    assert ours.exceptAll(twice).count() == 0 and ours.count() == twice.count() > 0
