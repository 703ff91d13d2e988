"""A training corpus from raw documents: five stages, each written as a table and read again by the next.

Every stage works on all rows its predecessor kept, and all but the last return the columns
of `documents`. SQL expresses neither the trained nor the near-duplicate stage, so there is
no oracle; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statweave.llm import decontaminate, near_dup, pieces, secrets, toxicity
from statweave.llm.common import written

MASK = "[secret]"
ORACLE_SQL: str | None = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field scores as toxic go. It learns from the labelled rows of the whole table."""
    labels = toxicity.rows_to_learn(_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, toxicity.train(_table(spark, sf_dir, "documents"), labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, alike by 0.8 or more, stays: the one with the least id."""
    return near_dup.drop_near_duplicates(docs, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes. n_chars follows the text where it changed."""
    masked = secrets.without_secrets(docs, mask=MASK)
    changed = F.col("text").contains(MASK)
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become ids; the text returned is what the ids decode to."""
    return pieces.with_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", drop_benchmark),
    ("secret_scan", mask_secrets),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
