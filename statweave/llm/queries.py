"""Registered corpus queries: key -> function of (spark, folder of the driver tables), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention, codes, decontaminate, hamming, language, near_dup, periodic, pieces, quality, secrets, sharding, sql, token_files, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    read = token_files.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, with_ids=False)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@register
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("linked")


ORACLES["op2_secret_scan"] = sql.SECRETS


@register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = toxicity.train(docs, toxicity.rows_to_learn(table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, field)
    return scored.select("doc_id", toxicity.held_out(scored.doc_id).alias("held_out"), "score", "predicted", "spans")


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.held_out(docs.doc_id, 3, 1)
    found = language.identify(docs, language.train(docs.where(~held_out)))
    return found.select("doc_id", toxicity.held_out(found.doc_id, 3, 1).alias("held_out"), "lang_pred", "score")


@register
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 24, ["source", "lang", "n_chars"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


@register
def op7_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.nearest(vectors, vectors.vec_id % 50 == 0, k=10)


ORACLES["op7_hamming_top_k"] = sql.HAMMING


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, toxicity.rows_to_learn(table(spark, sf_dir, "labels")))
    return quality.assess(docs, model, docs.source, docs.lang)


@register
def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.held_out(docs.doc_id, 5, 1)
    model = attention.train(docs, ~held_out, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = attention.scores(docs, model)
    return found.select("doc_id", toxicity.held_out(found.doc_id, 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_subwords")


@register
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"))


ORACLES["op12_vector_codes"] = sql.CODES


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=True).drop("n_kept")
