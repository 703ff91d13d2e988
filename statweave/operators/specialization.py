"""Location quotient: weight of a sector in an area against its weight in the wider region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rulebook as R
from .cuts import ratio, share_of_total, with_whole
from .flow import described


def location_quotient(
    stock: DataFrame, areas: DataFrame, codes: DataFrame, region: str = R.REGION_NAME
) -> DataFrame:
    """``stock`` is the regional stock; ``areas`` selects the areas that get a quotient."""
    known = stock.where(F.col("cnae_secao").isNotNull())
    wide = share_of_total(known, ["cnae_secao"], F.col("vinculos_ativos"), within=["ano_base"]).select(
        "ano_base", "cnae_secao", F.col("parte").alias("setor_estado"), F.col("total").alias("total_estado")
    )
    cuts = (
        with_whole(known.join(areas, "municipio_codigo"), "municipio_nome", region)
        .groupBy("ano_base", "recorte", "cnae_secao")
        .agg(F.sum("vinculos_ativos").alias("vinculos_setor"))
        .withColumn("_total", F.sum("vinculos_setor").over(Window.partitionBy("ano_base", "recorte")))
    )
    joined = described(cuts.join(wide, ["ano_base", "cnae_secao"]), codes, "secao", "cnae_secao", "cnae_secao_descricao")
    # (sector / cut) / (sector / wider region), as one division of whole numbers.
    count = "decimal(15,0)"
    here = F.col("vinculos_setor").cast(count) * F.col("total_estado").cast(count)
    there = F.col("_total").cast(count) * F.col("setor_estado").cast(count)
    return joined.select(
        "ano_base",
        "recorte",
        "cnae_secao",
        "cnae_secao_descricao",
        "vinculos_setor",
        ratio(F.col("vinculos_setor"), F.col("_total"), 2, 100).alias("participacao_recorte_pct"),
        ratio(F.col("setor_estado"), F.col("total_estado"), 2, 100).alias("participacao_ceara_pct"),
        ratio(here, there, 2, kind="decimal(31,0)").alias("quociente_locacional"),
    )
