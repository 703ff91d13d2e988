"""The flow fact kept up to date by adding each new lot to the months it touches.

Sums of codes per event month are stored, one folder a month. A lot brings rows of its own
month, late rows and cancellations of earlier ones; its sums are added to those months and
nothing else is read or written. Labels, the window and the preliminary mark are put on when
the fact is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rulebook as R
from ..operators import flow
from ..streaming import ledger
from .versions import Versions

MONTH = "competencia_mov"
_SCHEMA = ("municipio_codigo int, faixa_etaria string, sexo string, raca_cor string, cnae_secao string, grau_instrucao_codigo int, "
           "aprendiz boolean, faixa_salarial_sm string, admissoes bigint, desligamentos bigint, saldo bigint, "
           "linhas_no_prazo bigint, saldo_no_prazo bigint, saldo_atrasado bigint, saldo_excluido bigint")
CODES = [MONTH, *flow.FLOW_CODES]
SUMS = ["admissoes", "desligamentos", "saldo", "linhas_no_prazo", "saldo_no_prazo", "saldo_atrasado", "saldo_excluido"]


def stored(path: str) -> Versions:
    return Versions(path, MONTH, _SCHEMA, ("municipio_codigo", "cnae_secao"))


def sums_of(silver: DataFrame, wages: Mapping[int, float]) -> DataFrame:
    """The additive sums of typed events per code; events without a valid month are in no window and left out."""
    return flow.coded(silver.where(flow.is_month(F.col(MONTH))), CODES, wages, [*flow.flow_measures(), *flow.arrival_measures()], dealt=True).select(
        *CODES, *(F.col(s).cast("bigint").alias(s) for s in SUMS))


def months_of(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(MONTH).distinct().collect())  # months, not rows


def add(spark: SparkSession, fact: Versions, delta: DataFrame, mark: int, months: Iterable[int] | None = None) -> list[int]:
    """Add sums to the stored months; the months that were touched. A mark that was added already changes nothing.

    The sums of a month that is not stored yet are there already: only those of stored months
    are brought together with them. ``months`` names the months of ``delta`` where they are known.
    """
    if mark <= fact.mark(spark):
        return []
    months = months_of(delta) if months is None else sorted(months)
    known = sorted({member for member, *_ in fact.index(spark)}.intersection(months))
    changed = delta
    if known:
        again = F.col(MONTH).isin(known)
        both = fact.read(spark, known).unionByName(delta.where(again))
        changed = delta.where(~again).select(*CODES, *SUMS).unionByName(both.groupBy(*CODES).agg(*[F.sum(s).alias(s) for s in SUMS]))
    fact.publish(spark, changed, months, mark)
    return months


def follow(spark: SparkSession, fact: Versions, feed: ledger.Feed, silver: Callable[[DataFrame], DataFrame], wages: Mapping[int, float]) -> list[int]:
    """Bring the fact up to the newest lot of a feed: only rows of lots it has not taken in are read."""
    newest, done = ledger.last_lot(spark, feed), fact.mark(spark)
    if newest <= done:
        return []
    events = silver(ledger.rows(spark, feed, after=done))
    months = months_of(events.where(flow.is_month(F.col(MONTH))))  # from the events, before any of them is moved
    return add(spark, fact, sums_of(events, wages), newest, months)


def newest_month(spark: SparkSession, fact: Versions) -> int | None:
    """The newest month that has on-time rows."""
    return fact.read(spark).where("linhas_no_prazo > 0").agg(F.max(MONTH)).first()[0]


def published(spark: SparkSession, fact: Versions, areas: DataFrame, codes: DataFrame, keys: Sequence[str] = flow.FLOW_KEYS,
              months: int = R.WINDOW_MONTHS) -> DataFrame:
    """The labelled fact of the window; folders of earlier months are not read."""
    newest = newest_month(spark, fact)
    if newest is None:
        return flow.labelled(fact.read(spark, []), areas, codes, keys, F.lit(None).cast("int"))
    inside = [member for member, *_ in fact.index(spark) if member > flow.months_before(newest, months)]
    return flow.labelled(fact.read(spark, inside), areas, codes, keys, F.lit(newest))


def late_revisions(spark: SparkSession, fact: Versions) -> DataFrame:
    """Balance of every event month split by how it arrived, from the stored sums."""
    parts = ["saldo_no_prazo", "saldo_atrasado", "saldo_excluido"]
    return fact.read(spark).groupBy(MONTH).agg(*[F.sum(p).alias(p) for p in parts], F.sum("saldo").alias("saldo_revisado"))
