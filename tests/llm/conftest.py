from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "key", "kept", "score", "shard", "size", "spans", "n_tokens", "component_id", "set", "word", "p", "hit", "ids"]


def prose(seed: int, words: int, letters: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """NULLs in every column, empty, blank and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    near = base + " and one more word"
    return [
        (1, base, "en", "a", 10), (2, near, "en", "a", 10), (3, base, "de", "b", None), (3, base, "de", "b", None),
        (4, None, "en", "a", 0), (5, "", None, None, 0), (6, " \t\n ", "fr", "b", 4), (None, prose(2, 40), "en", "a", 3),
        (None, base, None, "a", 3), (7, prose(3, 60_000), "en", "b", 1), (8, "one two", "en", "a", 7), (9, "One  TWO", "en", "a", 7),
        (10, "é☃▁ \x00 漢字 " + prose(4, 30), "es", "b", 9), (11, "x" * 5000, "en", None, 5000),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows in a table with further columns whose names operators might use."""
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.select("*", *(F.lit("theirs").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs) -> dict[int, str]:
    return dict(docs.select("doc_id", "text").collect())
