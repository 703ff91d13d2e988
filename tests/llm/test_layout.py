"""Token files, shards, nearest codes and the pipeline."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from statweave.llm import decontaminate, hamming, near_dup, secrets, sharding, token_files, toxicity
from statweave.llm.common import written
from statweave.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_dup import brute
from tests.oracle_check import connect, difference

BPE = public_tokenizers.path("byte_bpe_50k.json")
BIG = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (1, 9), (7, 3), (1000, 10**9), (3000, 50)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    coded = token_files.EliasFano.of(values).to_bytes()
    back, size = token_files.EliasFano.from_bytes(memoryview(coded))
    assert size == len(coded) and back.all().tolist() == values.tolist() == [back.select(k) for k in range(n)]
    if n == 1000:
        assert len(coded) < n * (2 + np.log2(top / n)) / 8 * 1.2 + 100


def test_encoder_equals_the_library(texts):
    library, own, rng = Tokenizer.from_file(BPE), token_files.Encoder(BPE), random.Random(3)
    bits = [*"ab1'., \n\t\r\x1c\x85\xa0 é☃", "  ", " ", "'s", "<|endoftext|>"]
    given = ["", *texts.values(), *("".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(3000))]
    want = [e.ids for e in library.encode_batch(given, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(given)] == want


def test_token_query_by_brute_force(spark, sf_dir, texts):
    library, start = Tokenizer.from_file(BPE), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_files"](spark, sf_dir).collect()}
    for doc in sorted(texts):
        ids = library.encode(texts[doc], add_special_tokens=False).ids + [2]
        assert got.pop(doc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_token_files_of_odd_rows(spark, odd, odd_rows, empty, tmp_path):
    files = token_files.write_tokens(odd, BPE, 2, str(tmp_path / "a"), file_ids=1000)
    rows = sorted(token_files.read_tokens(files, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert files.count() > 2 and len(rows) == len(odd_rows)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in odd_rows), key=lambda x: (x is not None, x))
    assert [r.start for r in rows] == list(itertools.accumulate([0] + [r.n_tokens for r in rows[:-1]]))
    assert all(r.tokens[-1] == 2 and len(r.tokens) == r.n_tokens for r in rows)
    first = files.orderBy("part", "seq").first()
    one = token_files.TokenFile((tmp_path / "a" / first.file).read_bytes())
    assert one.doc_ids[0] is None and one.tokens(0).tolist() == rows[0].tokens
    assert token_files.round_trip(empty, BPE, 2).count() == 0


def test_hilbert_curve_walks_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3), (1, 4)):
        cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
        at = sharding.hilbert(cells, bits)
        assert sorted(at.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def test_shards_hold_equally_many_rows_of_close_metadata(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 3)
    rows = sharding.shards(docs, 24, ["source", "lang", "n_chars"]).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes = [sorted(r.slot for r in rows if r.shard == k) for k in range(24)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    along = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in along] == sorted(r.curve for r in rows)


def test_shards_of_odd_rows(spark, odd, odd_rows, empty, tmp_path):
    rows = sharding.shards(odd, 24, ["source", "lang", "n_chars", "text"]).collect()
    assert len(rows) == len(odd_rows) and sorted({r.shard for r in rows}).__len__() == len(odd_rows)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (4, 5)} == {(8, 0)}
    assert sharding.shards(empty, 24, ["source"]).count() == 0
    few = odd.where("doc_id IN (1, 2, 8, 9)").drop("shard", "id", "size")
    sharding.write_shards(few, sharding.shards(few, 2, ["n_chars"]), str(tmp_path / "s"))
    assert {r.shard: r.n for r in spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().withColumnRenamed("count", "n").collect()} == {0: 2, 1: 2}


def test_nearest_codes_equal_sql(spark):
    assert difference(spark, connect(BIG), BIG, QUERIES["op7_hamming_top_k"], ORACLES["op7_hamming_top_k"]) is None


def test_nearest_codes_with_ties_nulls_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hamming, "ENTRIES", 20)
    monkeypatch.setattr(hamming, "QUERIES", 3)
    rng = np.random.default_rng(2)
    vectors = [(k, rng.normal(size=40).tolist()) for k in range(150)] + [(200 + k, [1.0] * 40) for k in range(60)]
    vectors += [(300, None), (None, [1.0] * 40), (301, [1.0] * 8), (302, [None, 1.0]), (200, [1.0] * 40)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "'theirs' AS distance", "1 AS rank")
    codes = {i: np.array([x is not None and x > 0 for x in v] + [False] * (48 - len(v))) for i, v in vectors if i is not None and v is not None}
    want = {(q, n + 1, o, d) for q in codes if q % 50 == 0
            for n, (d, o) in enumerate(sorted((int((codes[q] ^ codes[o]).sum()), o) for o in codes if o != q)[:7])}
    got = hamming.nearest(df, df.vec_id % 50 == 0, 7)
    assert {tuple(r) for r in got.collect()} == want
    assert hamming.nearest(df.where("false"), df.vec_id % 50 == 0, 7).count() == 0


# --- pipeline ---------------------------------------------------------------------


def test_pipeline_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    field = toxicity.train(docs, toxicity.rows_to_learn(spark.read.parquet(f"{BIG}/labels.parquet")))
    items = [" ".join(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{BIG}/benchmark.parquet").collect()]
    left = {r.doc_id: r.text for r in docs.collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, BIG), name)
        got = {r.doc_id: r for r in now.collect()}
        assert now.columns[:5] == docs.columns and len(got) == now.count()
        if name == "toxicity":
            left = {i: t for i, t in left.items() if field.judge(t)[0] < 0.5}
        elif name == "near_dedup":
            left = {i: left[i] for i, c in brute_quick(left).items() if i == c}
        elif name == "decontamination":
            left = {i: t for i, t in left.items() if not any(f" {x} " in f" {' '.join(decontaminate.words_of(t))} " for x in items)}
        elif name == "secret_scan":
            assert all((corpus_pipeline.MASK in got[i].text) == (got[i].text != t) for i, t in left.items())
            assert secrets.scan(now).where("n_assign + n_access + n_hex > 0").count() == 0
            assert all(got[i].text == t for i, t in left.items() if not secrets_in(t))
            left = {i: r.text for i, r in got.items()}
        assert {i: r.text for i, r in got.items()} == left
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert len(now.columns) == 6 and corpus_pipeline.run(spark, BIG).count() == len(left)


def secrets_in(text: str) -> bool:
    from tests.llm.test_texts import base_spans

    return bool(base_spans(text)) or "AKIA" in text


def brute_quick(texts: dict[int, str]) -> dict[int, int]:
    """Components at the threshold of the pipeline's stage."""
    return brute(list(texts.items()), percent=80)


@pytest.fixture
def own_tables(spark, tmp_path):
    """Write a documents table beside the given labels and benchmark; its folder."""
    def write(docs):
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{BIG}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)
    return write


def test_pipeline_of_odd_rows(spark, odd, odd_rows, own_tables):
    extra = odd.columns[5:]
    docs = odd.withColumnRenamed("key", "set_")  # one more column of every row, whatever its name
    folder = own_tables(docs.coalesce(1))
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*docs.columns, "tokens"] and len(extra) > 5
    rows = [tuple(r)[:2] for r in out.collect()]
    # Of the copies of the base text and its near copy one stays; blank and NULL texts and all others do.
    assert sorted(r[0] for r in rows if r[0] is not None) == [1, 4, 5, 6, 7, 8, 10, 11]
    assert {t for i, t in rows if i in (4, 5)} == {None, ""}


def test_pipeline_of_an_empty_table(spark, empty, own_tables):
    out = corpus_pipeline.run(spark, own_tables(empty))
    assert out.count() == 0 and out.columns == [*empty.columns, "tokens"]


def test_cache_forgets_the_older_half():
    cache = token_files.Cache(1000)
    for k in range(30):
        cache.make_room()
        new = cache.missing([[f"w{k}", f"w{k}"], ["w0"]])
        assert f"w{k}" in new
        cache.learn(new, [b"xx"] * len(new))
    assert len(cache) < 12 and "w29" in cache and cache.bytes <= 1000 + 3 * 210


def test_encoder_with_a_small_cache(texts, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED", 20_000)
    monkeypatch.setattr(token_files, "LOT", 7)
    library, own = Tokenizer.from_file(BPE), token_files.Encoder(BPE)
    given = [*texts.values(), "'s 're\x85x a\x1fb c", "\u180e a", "tail ", " a b"]
    for at in range(0, len(given), 10):
        want = [e.ids for e in library.encode_batch(given[at:at + 10], add_special_tokens=False)]
        assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(given[at:at + 10])] == want


def test_stages_keep_odd_rows(spark, odd, odd_rows):
    base = odd.drop("key")
    assert secrets.without_secrets(base).count() == len(odd_rows)
    assert near_dup.drop_near_duplicates(base).columns == base.columns
