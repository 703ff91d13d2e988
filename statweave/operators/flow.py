"""Revisioned event feed: rolling window, signed flow facts, revisions by event month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rulebook as R
from ..functions import is_month, period_year, ratio_band, shift_months, year_lookup
from .quantiles import cube_quantiles, value_counts

FLOW_KEYS = [
    "competencia_mov", "preliminar", "municipio_codigo", "municipio_nome", "faixa_etaria", "sexo",
    "raca_cor", "cnae_secao", "cnae_secao_descricao", "escolaridade", "aprendiz", "faixa_salarial_sm",
]
OCCUPATION_KEYS = [
    "competencia_mov", "preliminar", "municipio_codigo", "municipio_nome", "faixa_etaria", "sexo",
    "cbo_codigo", "cbo_descricao",
]
MEDIAN_KEYS = ["periodo", "municipio_nome", "faixa_etaria", "sexo", "cnae_secao_descricao"]

# Published key -> silver columns it is derived from. Labels are looked up after the
# first aggregation, on group rows instead of on every event.
_CODE_OF = {
    "preliminar": "competencia_mov",
    "municipio_nome": "municipio_codigo",
    "cnae_secao_descricao": "cnae_secao",
    "escolaridade": "grau_instrucao_codigo",
    "cbo_descricao": "cbo_codigo",
}

# Codes of the flow fact besides the month.
FLOW_CODES = list(dict.fromkeys(_CODE_OF.get(k, k) for k in FLOW_KEYS if k not in ("competencia_mov", "preliminar")))


def last_month(silver: DataFrame, shift: int = 0, kind: str = "MOV") -> Column:
    """Newest on-time month (``yyyymm``) moved by some months, as a scalar subquery."""
    month = F.col("competencia_mov")
    newest = silver.where((F.col("origem_arquivo") == kind) & is_month(month)).agg(F.max(month).alias("_m"))
    return newest.select(shift_months(F.col("_m"), shift)).scalar()


def in_window(silver: DataFrame, months: int = R.WINDOW_MONTHS) -> DataFrame:
    """Events of the last ``months`` months up to the newest on-time month; no upper bound.

    The column is compared as it is with a bound worked out once, so the filter can also
    skip row groups of a stored silver table.
    """
    month = F.col("competencia_mov")
    return silver.where((month > last_month(silver, -months)) & is_month(month))


def preliminary(silver: DataFrame, months: int = R.PRELIMINARY_MONTHS) -> Column:
    return F.col("competencia_mov") > last_month(silver, -months)


def flow_measures() -> list[Column]:
    """Hires, separations and balance; cancellations carry their inverted sign in ``efeito``."""
    effect, balance = F.col("efeito"), F.col("saldo_movimentacao")
    return [
        F.sum(F.when(balance == 1, effect).otherwise(0)).alias("admissoes"),
        (-F.sum(F.when(balance == -1, effect).otherwise(0))).alias("desligamentos"),
        F.sum(effect).alias("saldo"),
    ]


def described(df: DataFrame, codes: DataFrame, domain: str, code: str, output: str) -> DataFrame:
    """Left lookup of a description: the domain predicate filters the dictionary first."""
    dictionary = codes.where(F.col("dominio") == domain).select(
        F.col("codigo").alias("_codigo"), F.col("descricao").alias(output)
    )
    return df.join(dictionary, F.col(code).cast("string") == F.col("_codigo"), "left").drop("_codigo")


def arrival_measures() -> list[Column]:
    """On-time rows, and the balance split by how its rows arrived: on time, late, cancelled."""
    effect, kind = F.col("efeito"), F.col("origem_arquivo")
    parts = {"MOV": "saldo_no_prazo", "FOR": "saldo_atrasado", "EXC": "saldo_excluido"}
    return [F.count_if(kind == "MOV").alias("linhas_no_prazo"),
            *[F.sum(F.when(kind == k, effect).otherwise(0)).alias(name) for k, name in parts.items()]]


def coded(silver: DataFrame, columns: Sequence[str], wages: Mapping[int, float], measures: Sequence[Column], dealt: bool = False) -> DataFrame:
    """Measures of events at the grain of codes; unknown members are named, labels come later.

    ``dealt`` moves the events themselves and adds up where they arrive: for codes so fine that
    adding up before would hold a group for nearly every event.
    """
    wage = year_lookup(period_year(F.col("competencia_mov")), wages)
    rated = silver.withColumn("_razao", F.try_divide(F.col("salario_mensal"), wage))
    known = {
        "faixa_etaria": F.coalesce("faixa_etaria", F.lit(R.UNKNOWN_F)),
        "sexo": F.coalesce("sexo", F.lit(R.UNKNOWN_M)),
        "raca_cor": F.coalesce("raca_cor", F.lit(R.UNKNOWN_F)),
        "aprendiz": F.col("categoria_codigo") == R.APPRENTICE,
        "faixa_salarial_sm": ratio_band(F.col("_razao")),
    }
    chosen = [known.get(c, F.col(c)).alias(c) for c in columns]
    events = rated.select(*chosen, "efeito", "saldo_movimentacao", "origem_arquivo")
    return (events.repartition(*columns) if dealt else events).groupBy(*columns).agg(*measures)


def labelled(coded_sums: DataFrame, areas: DataFrame, codes: DataFrame, keys: Sequence[str], newest: Column | None) -> DataFrame:
    """Coded sums with labels at the grain of ``keys``; ``newest`` is the newest on-time month."""
    grouped = coded_sums.join(areas, "municipio_codigo")
    if "cnae_secao_descricao" in keys:
        grouped = described(grouped, codes, "secao", "cnae_secao", "cnae_secao_descricao")
    if "cbo_descricao" in keys:
        grouped = described(grouped, codes, "cbo2002ocupacao", "cbo_codigo", "cbo_descricao").withColumn(
            "cbo_descricao", F.coalesce("cbo_descricao", F.concat(F.lit(R.OCCUPATION_PREFIX), "cbo_codigo"))
        )
    if "escolaridade" in keys:
        grouped = described(grouped, codes, "graudeinstrucao", "grau_instrucao_codigo", "escolaridade").withColumn(
            "escolaridade", F.coalesce("escolaridade", F.lit(R.UNKNOWN_F))
        )
    if "preliminar" in keys:
        grouped = grouped.withColumn("preliminar", F.col("competencia_mov") > shift_months(newest, -R.PRELIMINARY_MONTHS))
    measures = ["admissoes", "desligamentos", "saldo"]
    finer = set(coded_sums.columns) - {*measures, "linhas_no_prazo", "saldo_no_prazo", "saldo_atrasado", "saldo_excluido"} - {
        _CODE_OF.get(k, k) for k in keys}
    if finer or "escolaridade" in keys:
        # Several codes can share one label, and the area may not be asked for.
        grouped = grouped.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return grouped.select(*keys, *measures)


def flow_by(
    silver: DataFrame,
    areas: DataFrame,
    codes: DataFrame,
    keys: Sequence[str] = FLOW_KEYS,
    wages: Mapping[int, float] = R.MINIMUM_WAGE,
) -> DataFrame:
    """Additive flow fact at the grain of ``keys``: any filter is a plain sum over it."""
    columns = list(dict.fromkeys([_CODE_OF.get(k, k) for k in keys] + ["municipio_codigo"]))
    sums = coded(in_window(silver), columns, wages, flow_measures())
    return labelled(sums, areas, codes, keys, last_month(silver) if "preliminar" in keys else None)


def months_before(month: int, months: int) -> int:
    """``yyyymm`` some months earlier."""
    at = month // 100 * 12 + month % 100 - 1 - months
    return at // 12 * 100 + at % 12 + 1


def late_revisions(silver: DataFrame) -> DataFrame:
    """Balance of every event month split by how it arrived: on time, late, cancelled."""
    effect, kind = F.col("efeito"), F.col("origem_arquivo")

    def part(name: str) -> Column:
        return F.sum(F.when(kind == name, effect).otherwise(0))

    return silver.groupBy("competencia_mov").agg(
        part("MOV").alias("saldo_no_prazo"),
        part("FOR").alias("saldo_atrasado"),
        part("EXC").alias("saldo_excluido"),
        F.sum(effect).alias("saldo_revisado"),
    )


def admission_values(silver: DataFrame, areas: DataFrame, codes: DataFrame) -> DataFrame:
    """Counts of each monthly pay value among admissions (cancellations left out), labelled."""
    admitted = in_window(silver).where(
        (F.col("saldo_movimentacao") == 1)
        & F.col("origem_arquivo").isin("MOV", "FOR")
        & F.col("salario_mensal").isNotNull()
    )
    coded = admitted.select(
        F.col("competencia_mov").cast("string").alias("periodo"),
        "municipio_codigo",
        F.coalesce("faixa_etaria", F.lit(R.UNKNOWN_F)).alias("faixa_etaria"),
        F.coalesce("sexo", F.lit(R.UNKNOWN_M)).alias("sexo"),
        "cnae_secao",
        "salario_mensal",
    )
    keys = ["periodo", "municipio_codigo", "faixa_etaria", "sexo", "cnae_secao"]
    labelled = described(
        value_counts(coded, keys, "salario_mensal").join(areas, "municipio_codigo"),
        codes, "secao", "cnae_secao", "cnae_secao_descricao",
    )
    return labelled.withColumn("cnae_secao_descricao", F.coalesce("cnae_secao_descricao", F.lit(R.UNKNOWN_M)))


def median_cube(
    counts: DataFrame,
    keys: Sequence[str] = MEDIAN_KEYS,
    value: str = "salario_mensal",
    totals: Mapping[str, str] | None = None,
    collapsed: Sequence[str] = (),
    kept: Sequence[str] = (),
) -> DataFrame:
    """Median and sample size for every combination of the keys, totals included.

    A median cannot be added up, so each cell is computed from value counts. The lower
    of the two middle values is taken when the count is even.
    """
    totals = totals or {k: R.ALL_MONTHS if k == "periodo" else R.ALL for k in keys}
    return cube_quantiles(counts, keys, value, totals, [0.5], collapsed=collapsed, kept=kept).select(
        *keys,
        F.round(value, 2).alias("salario_mediano"),
        F.col("total").alias("admissoes_com_salario"),
    )
