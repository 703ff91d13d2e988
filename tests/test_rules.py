"""Column rules against plain Python twins and fixed cases."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statweave import functions as fn
from statweave import rulebook as R


def values(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def one_column(spark, items, kind, column):
    return values(spark, [(i,) for i in items], f"v {kind}", column)


def test_integer_trims_and_never_fails(spark):
    texts = [" 84116", "12", "-3", "+4", "\t5\n", "abc", None, "", " ", "7,5", "7.0", "-", "5-", "1e3", "99999999999"]
    assert one_column(spark, texts, "string", fn.integer("v")) == [84116, 12, -3, 4, 5] + [None] * 10


def test_decimals(spark):
    assert one_column(spark, ["1628,51", " 0,00", "x", "NaN", "Infinity"], "string", fn.decimal_comma("v")) == [
        1628.51, 0.0, None, None, None]
    assert one_column(spark, ["000411.81", "1518.00", ".00", "-1e3", "", "-Infinity"], "string", fn.decimal_point("v")) == [
        411.81, 1518.0, 0.0, -1000.0, None, None]


def test_zero_means_not_reported(spark):
    assert one_column(spark, [".00", "10.50", None, "-1"], "string", fn.positive_or_null("v")) == [None, 10.5, None, None]


@pytest.mark.parametrize("sexes, woman", [(R.FLOW_SEX, "3"), (R.STOCK_SEX, "2"), (R.SURVEY_SEX, "2")])
def test_labels_are_shared_by_the_sources(spark, sexes, woman):
    assert set(sexes.values()) == {"Homem", "Mulher"} and sexes[woman] == "Mulher"
    assert one_column(spark, ["1", f" {woman}", "9", None], "string", fn.conform_label("v", sexes)) == [
        "Homem", "Mulher", None, None]


def test_unidentified_codes_have_no_label():
    for table in (R.FLOW_SEX, R.FLOW_RACE, R.STOCK_SEX, R.STOCK_RACE, R.SURVEY_SEX, R.SURVEY_RACE):
        assert not {"9", "99", "-1"} & set(table)
    assert set(R.FLOW_RACE.values()) == set(R.STOCK_RACE.values()) == set(R.SURVEY_RACE.values())
    assert R.STOCK_RACE["8"] == R.SURVEY_RACE["4"] == R.FLOW_RACE["3"] == "Parda"


def age_twin(age):
    if age is None or age <= 0:
        return None
    limits = [(14, "<15"), (17, "15-17"), (24, "18-24"), (29, "25-29")]
    return next((label for high, label in limits if age <= high), "30+")


def test_age_band_equals_python(spark):
    ages = [None, *range(-2, 120)]
    assert one_column(spark, ages, "int", fn.age_band(F.col("v"))) == [age_twin(a) for a in ages]


def test_age_bands_have_no_gap():
    assert [low for low, _, _ in R.AGE_BANDS[1:]] == [high + 1 for _, high, _ in R.AGE_BANDS[:-1]]


def test_wage_years_are_contiguous_and_rising():
    years = sorted(R.MINIMUM_WAGE)
    assert years == list(range(years[0], years[-1] + 1))
    assert [R.MINIMUM_WAGE[y] for y in years] == sorted(R.MINIMUM_WAGE.values())


def test_region_has_19_six_digit_areas():
    assert len(R.REGION_AREAS) == 19 and all(len(str(code)) == 6 for code in R.REGION_AREAS)


def test_year_lookup_unknown_year_is_null(spark):
    assert one_column(spark, [2019, 2020, 2026, None], "int", fn.year_lookup(F.col("v"), R.MINIMUM_WAGE)) == [
        None, 1045.0, 1621.0, None]


def test_sign(spark):
    rows = [(1, "MOV"), (1, "FOR"), (1, "EXC"), (-1, "EXC"), (-1, "MOV")]
    assert values(spark, rows, "b int, t string", fn.signed_effect(F.col("b"), F.col("t"))) == [1, 1, -1, 1, -1]


def test_plausible_value_keeps_its_edges(spark):
    low, high = 0.3 * 1000.0, 30.0 * 1000.0
    rows = [(low, "5", 1000.0), (high, "5", 1000.0), (low - 0.01, "5", 1000.0), (high + 0.01, "5", 1000.0),
            (5000.0, "1", 1000.0), (5000.0, "5", None), (None, "5", 1000.0)]
    rule = fn.plausible_value(F.col("v"), F.col("u"), F.col("r"))
    assert values(spark, rows, "v double, u string, r double", rule) == [low, high, None, None, None, None, None]


def test_ratio_band_edges_and_missing_reference(spark):
    ratios = [0.5, 1.0, 1.01, 1.5, 2.0, 3.0, 5.0, 5.01, None]
    assert one_column(spark, ratios, "double", fn.ratio_band(F.col("v"))) == [
        "1. Até 1 SM", "1. Até 1 SM", "2. 1 a 1,5 SM", "2. 1 a 1,5 SM", "3. 1,5 a 2 SM", "4. 2 a 3 SM", "5. 3 a 5 SM",
        "6. Mais de 5 SM", "Sem salário mensal"]


def test_hour_band(spark):
    assert one_column(spark, [None, 0, -1, 1, 30, 31, 40, 41, 44, 45], "int", fn.hour_band(F.col("v"))) == (
        ["Não informada"] * 3 + ["1. Até 30 horas"] * 2 + ["2. 31 a 40 horas"] * 2 + ["3. 41 a 44 horas"] * 2
        + ["4. 45 horas ou mais"])


@pytest.mark.parametrize("subsector, size, label", [
    (5, 4, "Micro"), (19, 4, "Pequena"), (5, 7, "Média"), (19, 7, "Grande"), (10, 10, "Grande"),
    (24, 10, None), (None, 5, None), (19, None, None)])
def test_firm_size(subsector, size, label):
    table = {(s, t): name for s, t, name in R.firm_size_rows()}
    assert len(table) == 240
    assert table.get((subsector, size)) == label


def test_eligible_size(spark):
    rows = [(True, "Micro"), (False, "Micro"), (True, None), (None, "Micro")]
    assert values(spark, rows, "e boolean, s string", fn.eligible_size(F.col("e"), F.col("s"))) == [
        "Micro", "Não se aplica", "Não se aplica", "Não se aplica"]


def informal_twin(position, registry):
    if position is None:
        return None
    return position in (2, 4, 10) or (position in (8, 9) and registry == 2)


def test_informality_is_never_unknown_for_a_known_position(spark):
    rows = [(p, r) for p in [None, *range(1, 11)] for r in (None, 1, 2)]
    rule = fn.informality(F.col("p"), F.col("r"))
    assert values(spark, rows, "p int, r int", rule) == [informal_twin(p, r) for p, r in rows]


def test_turnover_flags_propagate_unknown(spark):
    rows = [(1, 0, 10, 11), (0, 12, 10, 11), (0, 12, 10, 21), (0, 12, 30, 11), (0, 12, 10, None), (None, 0, 10, 11)]
    entry, exit_ = fn.turnover_flags(*map(F.col, "abcd"))
    df = spark.createDataFrame(rows, "a int, b int, c int, d int").select(entry.alias("i"), exit_.alias("o"))
    assert [tuple(r) for r in df.collect()] == [
        (True, False), (False, True), (False, False), (False, False), (False, None), (None, False)]


def test_major_group_and_month_index(spark):
    assert one_column(spark, ["010105", "521110", "", None], "string", fn.major_group(F.col("v"))) == [
        R.MAJOR_GROUP_LABELS["0"], R.MAJOR_GROUP_LABELS["5"], "Não informado", "Não informado"]
    assert one_column(spark, [202601, 202512, 202600, 202613, None], "int", fn.month_index(F.col("v"))) == [
        2026 * 12, 2025 * 12 + 11, None, None, None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-10**6, 10**6)), min_size=1, max_size=20))
def test_integer_round_trip(spark, numbers):
    texts = [None if n is None else f"  {n} " for n in numbers]
    assert one_column(spark, texts, "string", fn.integer("v")) == numbers
