"""Operators against brute force and hand-made rows."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction
from itertools import product

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from statweave import rulebook as R
from statweave.operators import cuts, flow, inequality, profile, quality, quantiles, specialization, survey
from statweave.plans import silver


def lower_quantile(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(round(p * len(ordered), 9)), 1) - 1]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, values repeat, some are zero, negative or far apart."""
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", "b", None]),
             rng.choice([0.0, 0.01, -5.25, 1000.0, 1e9, round(rng.uniform(0, 5000), 2)])) for _ in range(4000)]
    return rows, spark.createDataFrame(rows, "k string, v double")


def test_ordered_bin_never_decreases(spark):
    values = sorted([0.0, -1e12, 1e12, 1e-9, -0.01, *[random.Random(1).uniform(-1e7, 1e7) for _ in range(2000)]])
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", quantiles.ordered_bin(F.col("v")).alias("b"))
    found = [r.b for r in sorted(df.collect(), key=lambda r: r.v)]
    assert found == sorted(found)


def test_group_quantiles_equal_brute_force(skewed):
    rows, df = skewed
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    probabilities = [0.01, 0.25, 0.5, 0.99, 1.0]
    found = {(r.k, r.p): (r.v, r.total) for r in quantiles.group_quantiles(df, ["k"], "v", probabilities).collect()}
    assert found == {(k, p): (lower_quantile(vs, p), len(vs)) for k, vs in groups.items() for p in probabilities}


def test_wanted_cells_equal_those_of_the_whole_cube(spark):
    counts = spark.createDataFrame(
        [("x", "m", 1.0, 2), ("x", "n", 1.0, 3), ("x", "n", 2.0, 9), ("y", "m", 5.0, 3)], "a string, b string, v double, n long")
    totals = {"a": "ALL", "b": "Todos"}
    whole = quantiles.cube_quantiles(counts, ["a", "b"], "v", totals, [0.5]).where("a <> 'ALL' AND b = 'Todos'")
    wanted = quantiles.cube_quantiles(counts, ["a", "b"], "v", totals, [0.5], collapsed=["b"], kept=["a"])
    assert sorted(wanted.collect()) == sorted(whole.collect()) == [("x", "Todos", 0.5, 14, 2.0), ("y", "Todos", 0.5, 3, 5.0)]


def test_cube_quantiles_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), rng.choice(["1", "2", "Todos"]), float(rng.randint(1, 400))) for _ in range(1500)]
    counts = quantiles.value_counts(spark.createDataFrame(rows, "a string, b string, v double"), ["a", "b"], "v")
    cells = defaultdict(list)
    for a, b, v in rows:
        for total_a, total_b in product((False, True), repeat=2):
            cells[("ALL" if total_a else a, "Todos" if total_b else b, total_a, total_b)].append(v)
    found = quantiles.cube_quantiles(counts, ["a", "b"], "v", {"a": "ALL", "b": "Todos"}, [0.5]).collect()
    # A member spelled like the total keeps its own cell.
    expected = Counter((k[0], k[1], lower_quantile(vs, 0.5), len(vs)) for k, vs in cells.items())
    assert Counter((r.a, r.b, r.v, r.total) for r in found) == expected


def plain_gini(values):
    ordered, n = sorted(values), len(values)
    return 2 * sum((i + 1) * x for i, x in enumerate(ordered)) / (n * sum(ordered)) - (n + 1) / n


def test_gini_equals_row_ranks(spark):
    rng = random.Random(5)
    rows = [("hot", rng.choice([1518.0, round(rng.lognormvariate(7, 1), 2)])) for _ in range(3000)]
    rows += [("even", 100.0)] * 4 + [("one", 0.01)] * 3 + [("one", 100.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: r.gini for r in inequality.gini_of_counts(quantiles.value_counts(df, ["k"], "v"), ["k"], "v").collect()}
    for key in ("hot", "even", "one"):
        assert found[key] == pytest.approx(plain_gini([v for k, v in rows if k == key]), abs=5.1e-6)
    assert found["even"] == pytest.approx(0, abs=1e-12) and found["one"] == pytest.approx(0.75, abs=1e-3)


FLOW_DDL = ("origem_arquivo string, competencia_mov int, municipio_codigo int, saldo_movimentacao int, efeito int, "
            "faixa_etaria string, sexo string, raca_cor string, cnae_secao string, grau_instrucao_codigo int, "
            "categoria_codigo string, cbo_codigo string, salario_mensal double")


def event(kind, month, balance, pay=None, area=1, education=7):
    sign = -1 if kind == "EXC" else 1
    return (kind, month, area, balance, sign * balance, None, "Mulher", "Parda", "A", education, "103", "010105", pay)


@pytest.fixture(scope="module")
def dims(spark):
    areas = spark.createDataFrame([(1, "Um"), (2, "Dois")], "municipio_codigo int, municipio_nome string")
    codes = spark.createDataFrame(
        [("secao", "A", "Agro"), ("secao", "B", "Minas"), ("graudeinstrucao", "7", "Médio Completo")],
        "dominio string, codigo string, descricao string")
    return areas, codes


def flows(spark, dims, events, *keys):
    df = flow.flow_by(spark.createDataFrame(events, FLOW_DDL), *dims, keys)
    return {tuple(r[k] for k in keys): (r.admissoes, r.desligamentos, r.saldo) for r in df.collect()}


@pytest.mark.parametrize("events, expected", [
    ([("MOV", 1), ("MOV", -1)], (1, 1, 0)),
    ([("MOV", 1), ("EXC", 1)], (0, 0, 0)),
    ([("EXC", 1)], (-1, 0, -1)),
    ([("MOV", -1), ("EXC", -1)], (0, 0, 0)),
    ([("EXC", -1)], (0, -1, 1)),
])
def test_signs_of_cancellations(spark, dims, events, expected):
    month = ("MOV", 202606, 1)  # keeps the window in place, in another area
    rows = [event(kind, 202606, balance) for kind, balance in events] + [event(*month, area=2)]
    assert flows(spark, dims, rows, "municipio_nome")[("Um",)] == expected


def test_window_follows_on_time_months_only(spark, dims):
    rows = [event("MOV", 202606, 1), event("FOR", 202507, 1), event("FOR", 202506, 1), event("EXC", 202701, 1),
            event("FOR", 202613, 1)]
    found = flows(spark, dims, rows, "competencia_mov", "preliminar")
    assert set(found) == {(202606, True), (202507, False), (202701, True)}


def test_preliminary_is_the_last_three_months(spark, dims):
    rows = [event("MOV", m, 1) for m in (202601, 202602, 202603, 202604, 202512)]
    assert {k[0]: k[1] for k in flows(spark, dims, rows, "competencia_mov", "preliminar")} == {
        202512: False, 202601: False, 202602: True, 202603: True, 202604: True}


def test_codes_with_one_label_become_one_row(spark, dims):
    rows = [event("MOV", 202606, 1, education=None), event("MOV", 202606, 1, education=99), event("MOV", 202606, 1)]
    assert flows(spark, dims, rows, "escolaridade") == {("Não informada",): (2, 0, 2), ("Médio Completo",): (1, 0, 1)}


def test_areas_outside_the_region_are_left_out(spark, dims):
    assert flows(spark, dims, [event("MOV", 202606, 1), event("MOV", 202606, 1, area=9)], "sexo") == {
        ("Mulher",): (1, 0, 1)}


def test_coarser_grain_equals_summed_grain(spark, dims):
    rng = random.Random(2)
    rows = [event(rng.choice(["MOV", "FOR", "EXC"]), rng.choice([202605, 202606]), rng.choice([1, -1]),
                  rng.choice([None, 1600.0, 9000.0]), rng.choice([1, 2])) for _ in range(300)]
    rows.append(event("MOV", 202606, 1))
    fine = flow.flow_by(spark.createDataFrame(rows, FLOW_DDL), *dims)
    assert fine.columns == flow.FLOW_KEYS + ["admissoes", "desligamentos", "saldo"]
    total = fine.groupBy("municipio_nome").agg(F.sum("saldo").alias("s"))
    assert {r.municipio_nome: r.s for r in total.collect()} == {
        k[0]: v[2] for k, v in flows(spark, dims, rows, "municipio_nome").items()}


def test_median_leaves_cancellations_out(spark, dims):
    rows = [event("MOV", 202606, 1, 100.0), event("FOR", 202606, 1, 200.0), event("EXC", 202606, 1, 900.0),
            event("MOV", 202606, -1, 800.0), event("MOV", 202606, 1, None)]
    counts = flow.admission_values(spark.createDataFrame(rows, FLOW_DDL), *dims)
    cells = flow.median_cube(counts).collect()
    assert len(cells) == 32 and {(r.salario_mediano, r.admissoes_com_salario) for r in cells} == {(100.0, 2)}


def test_late_revisions(spark):
    rows = [event("MOV", 202601, 1), event("FOR", 202601, 1), event("EXC", 202601, 1), event("FOR", 202512, -1)]
    found = {r[0]: tuple(r)[1:] for r in flow.late_revisions(spark.createDataFrame(rows, FLOW_DDL)).collect()}
    assert found == {202601: (1, 1, -1, 1), 202512: (0, -1, 0, -1)}


def test_unknown_outcome_is_a_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    observation = Observation("checks")
    kept = quality.expect_or_drop(df, {"positive": "v > 0"}, observation).collect()
    assert [r.v for r in kept] == [1] and observation.get == {"linhas": 3, "positive": 2}
    assert [tuple(r) for r in quality.expect_report(df, {"positive": F.col("v") > 0}).collect()] == [("positive", 3, 2)]


STOCK_DDL = ("ano_base int, municipio_codigo int, ativo_31_12 boolean, admissao_rotatividade boolean, "
             "desligamento_rotatividade boolean, remuneracao_media_nominal double")


def test_turnover_does_not_mix_years_and_survives_an_empty_stock(spark, dims):
    rows = [(2024, 1, True, True, False, 10.0), (2024, 1, True, True, True, 30.0), (2024, 1, False, None, True, 50.0),
            (2025, 1, True, True, True, 10.0), (2025, 2, False, True, True, 10.0)]
    found = {(r.ano_base, r.recorte): r for r in inequality.inequality_turnover(
        spark.createDataFrame(rows, STOCK_DDL), dims[0]).collect()}
    assert found[2024, "Um"].taxa_rotatividade_pct == 100.0 and found[2024, "RMF"].estoque == 2
    assert found[2024, "Um"].gini == 0.25 and found[2025, "Dois"].gini is None
    assert found[2025, "Dois"].taxa_rotatividade_pct is None and found[2025, "RMF"].taxa_rotatividade_pct == 200.0


def test_location_quotient(spark, dims):
    rows = [(2024, 1, "A", 30), (2024, 1, "B", 10), (2024, 2, "A", 10), (2024, 2, "B", 30), (2024, 9, "A", 20),
            (2024, 9, None, 500)]
    stocked = spark.createDataFrame(rows, "ano_base int, municipio_codigo int, cnae_secao string, vinculos_ativos bigint")
    found = {(r.recorte, r.cnae_secao): (r.vinculos_setor, r.participacao_recorte_pct, r.participacao_ceara_pct,
                                         r.quociente_locacional)
             for r in specialization.location_quotient(stocked, *dims).collect()}
    assert found["Um", "A"] == (30, 75.0, 60.0, 1.25) and found["RMF", "A"] == (40, 50.0, 60.0, 0.83)
    assert len(found) == 6


SURVEY_ROWS = [
    # capital, weight, sex, race, age, force, employed, position, registry, income
    ("23", "10.0", "1", "1", "030", "1", "1", "01", None, "00001000"),
    ("23", "20.0", "2", "2", "020", "1", "1", "09", None, "00000500"),
    ("", "30.0", "2", "4", "025", "1", "2", None, None, None),
    ("", "40.0", "1", "9", "010", None, None, None, None, None),
    ("", "5.0", "2", "1", "040", "1", "1", "10", None, None),
    ("", "0.0", "2", "1", "040", "1", "1", "10", None, None),
]
SURVEY_COLUMNS = ("capital peso sexo cor_raca idade condicao_forca_trabalho condicao_ocupacao posicao_categoria "
                  "negocio_cnpj rendimento_habitual").split()


@pytest.fixture(scope="module")
def components(spark):
    fixed = {"ano": "2026", "trimestre": "2"}
    raw = spark.createDataFrame(SURVEY_ROWS, ", ".join(f"{c} string" for c in SURVEY_COLUMNS))
    for name in R.SURVEY_LAYOUT:
        if name not in SURVEY_COLUMNS:
            raw = raw.withColumn(name, F.lit(fixed.get(name)).cast("string"))
    deflators = spark.createDataFrame([(2026, 1, 2.0)], "ano int, trimestre int, deflator_habitual double")
    return survey.weighted_components(silver.survey_silver(raw, R.Rules()), deflators)


def test_survey_rates_by_hand(components):
    rates = {(r.recorte, r.sexo, r.publico): r for r in survey.survey_rates(components).collect()}
    whole = rates["RMF", "Todos", "Todos"]
    assert (whole.pessoas_amostra, whole.desocupados_amostra, whole.pessoas_forca_trabalho) == (5, 1, 65.0)
    assert whole.taxa_desocupacao_pct == 46.2 and whole.pessoas_idade_trabalhar == 65.0
    # Position 9 with an unknown registry is not informal; position 10 always is.
    assert whole.taxa_informalidade_pct == 14.3 and whole.conta_propria_pct == 57.1
    assert whole.renda_media_habitual == round(20000 / 30, 2) and whole.razao_renda_mulher_homem_pct == 50.0
    # No deflator for the quarter: no real income, instead of one that is too low.
    assert whole.renda_media_real is None and whole.amostra_suficiente is False
    assert whole.taxa_subocupacao_pct is None
    young = rates["RMF", "Todos", R.YOUNG_PUBLIC]
    assert young.pessoas_amostra == 2 and young.taxa_desocupacao_pct == 60.0
    assert rates["Fortaleza", "Todos", "Todos"].pessoas_amostra == 2
    assert rates["Demais municípios da RMF", "Mulher", R.OTHER_PUBLIC].pessoas_ocupadas == 5.0


def test_rolled_up_components_equal_direct_ones(components):
    rolled = survey.rollup_components(components, ["ano"]).first()
    assert rolled.populacao == 105.0 and rolled.pessoas_amostra == 5 and rolled.peso_renda == 30.0


def test_whole_is_the_sum_of_its_parts(components):
    found = {r.recorte: r.n for r in survey.overlapping_cuts(components).groupBy("recorte").agg(
        F.sum("pessoas_amostra").alias("n")).collect()}
    assert found["RMF"] == found["Fortaleza"] + found["Demais municípios da RMF"] == 5


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    assert {(r.k, r.parte, r.total) for r in cuts.share_of_total(df, ["k"], F.col("v")).collect()} == {
        ("a", 3, 8), ("b", 5, 8)}


def test_constant_columns(spark):
    df = spark.createDataFrame([("x", 1, None), ("x", 2, None)], "a string, b int, c string")
    assert profile.constant_columns(df) == ["a", "c"]
    assert profile.drop_constant_columns(df).columns == ["b"]
    report = {r.coluna: (r.distintos, r.pct_sentinela)
              for r in profile.uninformative_columns(df, ["a", "b", "c"], {"b": "1"}).collect()}
    assert report == {"a": (1, 0.0), "b": (2, 50.0), "c": (0, 0.0)}


def test_reconcile_reports_both_sides(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    expected = spark.createDataFrame([(1, 2), (3, 4)], "k int, esperado bigint")
    assert {tuple(r) for r in profile.reconcile_counts(df, ["k"], expected).collect()} == {
        (1, 2, 2, 0), (2, 1, 0, 1), (3, 0, 4, -4)}


def test_percentile_profile_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "k string, v double")
    found = {r.k: tuple(r)[1:] for r in profile.percentile_profile(df, ["k"], F.col("v"), {"p50": 0.5}).collect()}
    assert found == {"a": (2, 1.0, 2.0), None: (1, 5.0, 5.0), "b": (1, None, None)}


def test_money_is_added_exactly(spark):
    many = spark.range(100_000).select(F.lit(90_000_000_000.07).alias("v"))
    assert many.agg(cuts.money_sum(F.col("v"))).first()[0] == 9_000_000_000_007_000.0
    few = spark.createDataFrame([(0.1,), (0.2,), (None,), (-0.3,)], "v double")
    assert few.agg(cuts.money_sum(F.col("v"))).first()[0] == 0.0


def test_ratios_are_rounded_once(spark):
    rows = [(44999996, 100000000), (45, 100), (-45, 100), (45, -100), (1, 3), (2, 3), (0, 7), (5, 0), (None, 2), (7, None), (10**11, 3)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = [r.x for r in df.select(cuts.ratio(F.col("a"), F.col("b"), 1).alias("x")).collect()]
    assert got == [0.4, 0.5, -0.5, -0.5, 0.3, 0.7, 0.0, None, None, None, 33333333333.3]
    assert df.select(cuts.rounded(F.lit(0.44999996), 1), cuts.rounded(F.lit(2.5), 0), cuts.rounded(F.lit(-2.5), 0)).first()[:] == (0.4, 3.0, -3.0)
    rng = random.Random(4)
    pairs = [(rng.randint(-10**9, 10**9), rng.randint(-10**6, 10**6)) for _ in range(400)] + [(k, 8) for k in range(-40, 40)]
    for digits, times in ((0, 1), (1, 100), (2, 1), (5, 1)):
        got = [r.x for r in spark.createDataFrame(pairs, "a long, b long").select(cuts.ratio(F.col("a"), F.col("b"), digits, times).alias("x")).collect()]
        want = [None if not b else float(round_half_up(Fraction(a * times, b), digits)) for a, b in pairs]
        assert got == want


def round_half_up(value, digits):
    scaled = abs(value) * 10**digits
    return Decimal((1 if value >= 0 else -1) * int(scaled + Fraction(1, 2))).scaleb(-digits)


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    """Three million weights added in two orders: the same bits, where sums of doubles differ."""
    df = spark.range(3_000_000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e7).alias("w"), "id")
    orders = [df.repartition(8, "id"), df.repartition(3, F.xxhash64("id", F.lit(1))).sortWithinPartitions(F.desc("w"))]
    exact = [d.agg(cuts.amount_sum(F.col("w")).alias("s"), cuts.ratio(cuts.amount_sum(F.col("w")), F.count("w"), 5).alias("m")).first() for d in orders]
    assert exact[0] == exact[1] and exact[0].m == pytest.approx(50, abs=0.1)


def test_profile_means_survive_texts_that_are_no_amounts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1e200), ("b", 3.0), ("c", None)], "k string, v double")
    got = {r.k: r.media for r in profile.percentile_profile(df, ["k"], F.col("v"), {"p50": 0.5}).collect()}
    assert got == {"a": 2.0, "b": pytest.approx(5e199), "c": None}


def test_drops_are_counted_by_rule(spark):
    df = spark.createDataFrame([(1, 1), (-1, 1), (None, 1), (-1, -1), (1, -1)], "v int, w int")
    got = quality.drop_report(df, {"v": "v > 0", "w": F.col("w") > 0}).collect()
    assert [tuple(r) for r in got] == [("v", 5, 3, 2), ("w", 5, 2, 1)]
    assert quality.expect_or_drop(df, {"v": "v > 0", "w": "w > 0"}).count() == 1
