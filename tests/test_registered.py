"""Registered queries against their SQL, and what their plans may not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registered
from statweave.plans.catalog import QUERIES
from statweave.plans.oracles import ORACLES as SQL
from tests.oracle_check import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 100
    assert set(QUERIES) <= set(registered.queries()) and set(SQL) <= set(registered.oracle_sql())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns[-3:] == ["admissoes", "desligamentos", "saldo"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, key):
    assert difference(spark, con, sf_dir, QUERIES[key], SQL[key]) is None


@pytest.mark.parametrize("key", ["sorted_output", "top_k", "q_top_sectors", "q_top_occupations", "q_stock_occupations"])
def test_sorted_queries_keep_their_order(spark, sf_dir, con, key):
    theirs = con.execute(SQL[key])
    names, rows = [d[0] for d in theirs.description], theirs.fetchall()
    assert rows and [tuple(row[n] for n in names) for row in QUERIES[key](spark, sf_dir).collect()] == rows


@pytest.mark.parametrize("key", ["q_median_by_sector", "q_median_point", "drop_constant_columns"])
def test_results_are_not_empty(spark, key):
    assert QUERIES[key](spark, "/root/testdata/sf0.01").count() > 0


HEAVY = ["flow_fact", "flow_by_occupation", "median_cube", "stock_fact", "stock_by_occupation", "gini", "turnover_rate",
         "location_quotient", "weighted_components", "survey_rates", "weighted_by_category", "percentile_profile",
         "share_of_total", "late_revisions", "q_rank_areas", "rule_impact"]


@pytest.mark.parametrize("key", HEAVY)
def test_plans_stay_on_the_jvm_and_scale(spark, sf_dir, key):
    plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Scan ExistingRDD", plan)
    # A window over all rows would sort them in one task; only scalar totals may meet in one partition.
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_scans_read_only_the_needed_columns(spark, sf_dir):
    plan = QUERIES["late_revisions"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan


def test_inequality_reads_the_contracts_once(spark, sf_dir):
    df = QUERIES["inequality_turnover"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet [o_") == 1
