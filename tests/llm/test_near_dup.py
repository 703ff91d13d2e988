from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statweave.llm import near_dup
from statweave.llm.common import connected, join_crowded
from statweave.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, prose


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows: list[tuple], percent: int = 85) -> dict[int, int]:
    """Least id of each id's component, by comparing every pair."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in rows}


def edited(words: list[str], rng, changes: int) -> str:
    out = list(words)
    for k in rng.choice(len(out), changes, replace=False):
        out[k] = f"w{rng.integers(1 << 40)}"
    return " ".join(out)


def test_query_equals_brute_force(spark, sf_dir, texts):
    got = {r.doc_id: r for r in QUERIES["op1_minhash_near_dedup"](spark, sf_dir).collect()}
    want = brute(list(texts.items()))
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingle_set(texts[i])) for i, r in got.items())


def test_a_large_family_around_the_threshold(spark):
    """400 edited copies of one text: linked through the original or not at all, in several pairs of blocks."""
    rng = np.random.default_rng(5)
    base = prose(9, 300).split()
    rows = [(1000 + k, edited(base, rng, int(rng.integers(2, 12)))) for k in range(400)] + [(5, " ".join(base))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()}
    assert got == brute(rows) and len(set(got.values())) > 2


def test_the_stage_links_from_four_fifths_on(spark):
    """Copies between 0.75 and 0.95, most of them between 0.80 and 0.85, of 60 texts; op1 keeps its 85 %."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        base = prose(100 + k, 400).split()
        rows += [(10 * k, " ".join(base)), *((10 * k + n, edited(base, rng, changes)) for n, changes in ((1, 8), (2, 9), (3, 11)))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    want = {i for i, least in brute(rows, 80).items() if i == least}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == want
    assert len(want) < len(set(brute(rows).values())) - 20


@pytest.mark.parametrize("percent", [100, 95, 85, 80, 70, 50])
def test_bands_follow_the_threshold(percent):
    rows = near_dup.band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** near_dup.BANDS <= near_dup.MISSED
    assert rows == near_dup.ROWS or (1 - (percent / 100) ** (rows + 1)) ** near_dup.BANDS > near_dup.MISSED


def test_odd_rows(odd, odd_rows):
    out = near_dup.near_duplicates(odd)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == len(odd_rows)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in out.collect()}
    assert got[(1, 116)] == (1, True) and got[(2, 120)] == (1, False) and got[(3, 116)] == (1, False)
    assert got[(None, 116)] == (1, False) and got[(None, 36)] == (None, True)
    assert got[(4, 0)] == (4, True) and got[(5, 0)] == (5, True) and got[(6, 0)] == (6, True)
    assert got[(8, 1)] == (8, True) and got[(9, 1)] == (8, False)
    left = near_dup.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.where("kept = 'theirs'").count() == left.count()
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, [1, 4, 5, 6, None, 7, 8, 10, 11]))


def test_empty_table(empty):
    assert near_dup.near_duplicates(empty).count() == 0 and near_dup.drop_near_duplicates(empty).count() == 0


def test_estimate_is_corrected_for_chance(spark):
    a, b = (near_dup.minima([np.arange(lo, lo + 1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)]) for lo in (0, 100))
    same = near_dup.agreement(near_dup.packed(a), near_dup.packed(b))[0]
    assert abs((same / near_dup.HASHES - 0.25) / 0.75 - 900 / 1100) < 0.12
    pair = spark.createDataFrame([([*map(int, near_dup.packed(a)[0].view(np.int64))], [*map(int, near_dup.packed(b)[0].view(np.int64))])], "a array<long>, b array<long>")
    assert pair.select(near_dup.agreement_sql(F.col("a"), F.col("b"))).first()[0] == same


@pytest.mark.parametrize("edges,roots", [
    ([], {}), ([(b"b", b"a"), (b"c", b"b"), (b"d", b"c"), (b"e", b"d"), (b"z", b"y")], {b"a": b"a", b"b": b"a", b"c": b"a", b"d": b"a", b"e": b"a", b"y": b"y", b"z": b"y"})])
def test_connected(spark, edges, roots):
    found = connected(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert {bytes(r.node): bytes(r.root) for r in found} == roots


def test_crowded_keys_are_dealt_to_many_tasks(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 900).alias("k"), F.col("id").alias("v"))
    heads = rows.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.min("v").alias("least")).where("size > 1")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", limit):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = join_crowded(rows, heads, "k", "v", 100)
        assert sorted(map(tuple, got.select("k", "v", "size", "least").collect())) == sorted(map(tuple, rows.join(heads, "k").select("k", "v", "size", "least").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
