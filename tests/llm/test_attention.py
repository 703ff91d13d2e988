"""The attention model against brute force: gradients, windows, counts and scores."""

from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from statweave.llm import attention
from statweave.llm.queries import QUERIES
from statweave.llm.toxicity import held_out

CODER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def source():
    return attention.subwords(*CODER)


def words(text):
    out = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in out if w]


def test_subwords_of_words_one_by_one(source):
    own = tiktoken.Encoding("own", pat_str=CODER[1], mergeable_ranks=source.ranks, special_tokens={})
    some = ["a", "the,", "naïve", "x\xa0y", "\x85", "漢字", "don't", "\x00", "🙂🙂", "<|endoftext|>", "a\x1cb", "zz" * 400, " "]
    got = source.of([w.encode() for w in some])
    assert [g.tolist() for g in got] == [own.encode_ordinary(" " + w) for w in some]
    assert all(w.encode() == attention.words_of(w)[0] for w in some if w.lower() == w)


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(1)
    model = attention.Attention(7, 5, 6, 4)
    model.weights = (rng.normal(0, 0.5, model.size)).astype(np.float32)
    x, y = rng.integers(0, 7, (3, 6)), rng.integers(0, 5, (3, 6))
    real = rng.random((3, 6)) < 0.8

    def loss(weights):
        m = attention.Attention(7, 5, 6, 4, weights)
        p = m.chances(x)
        return -sum(math.log(p[b, t, y[b, t]]) for b, t in zip(*np.nonzero(real))) / real.sum()

    given = attention.Attention(7, 5, 6, 4, model.weights)
    found, grad = given.gradient(x, y, real)
    assert found == pytest.approx(loss(model.weights), rel=1e-5)
    for k in range(0, model.size, 3):
        step = np.zeros(model.size, np.float32)
        step[k] = 1e-2
        assert grad[k] == pytest.approx((loss(model.weights + step) - loss(model.weights - step)) / 2e-2, abs=2e-3)


def test_gradient_holds_one_table_of_classes():
    """Shares of classes are made in place and never divided out: one table of places by classes, not two."""
    model = attention.Attention(7, 3000, 32, 4)
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 7, (8, 32)), rng.integers(0, 3000, (8, 32))
    tracemalloc.start()
    model.gradient(x, y, np.ones((8, 32), bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * x.size * 3000 * 4


@pytest.mark.parametrize("logit", [84, 200])
def test_powers_too_large_for_floats(logit):
    """Powers that floats cannot hold, or just hold: shares, gradient and scoring agree with doubles."""
    model = attention.Attention(7, 5, 6, 4)
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 7, (200, 6)), np.full((200, 6), 2)
    for name, times in (("E", 30), ("Q", 30), ("K", 30)):
        model.parts[name][:] *= times
    model.parts["c"][2] += logit
    parts = {name: part.astype(float) for name, part in model.parts.items()}
    h = parts["E"][x] + parts["P"]
    s = (h @ parts["Q"]) @ (h @ parts["K"]).transpose(0, 2, 1) / 2 + np.where(np.tri(6) > 0, 0, -np.inf)
    a = np.exp(s - s.max(axis=2, keepdims=True))
    z = (h + (a / a.sum(axis=2, keepdims=True)) @ (h @ parts["V"]) @ parts["O"]) @ parts["U"] + parts["c"]
    want = z[..., 2] - z.max(axis=2) - np.log(np.exp(z - z.max(axis=2, keepdims=True)).sum(axis=2))
    with np.errstate(over="ignore", invalid="ignore"):
        loss, grad = model.gradient(x, y, np.ones((200, 6), bool))
        assert loss == pytest.approx(-want.mean(), abs=1e-5) and np.isfinite(grad).all()
        assert np.allclose(model.log_chances(model.folded(), x, y), want, atol=1e-5)
        assert np.allclose(model.gradient(x, y - 2, np.ones((200, 6), bool))[1][-5:], [-1, 0, 1, 0, 0], atol=1e-5)


def test_new_words_are_numbered_and_coded_once(source, monkeypatch):
    """One look at each word; also after a call that ended before its new words were coded."""
    met = attention.Words(source, {b"": 3, b"a": 9})
    coded = source.coded
    monkeypatch.setattr(source, "coded", lambda words: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        met.numbers([b"x", b"a"])
    monkeypatch.setattr(source, "coded", coded)
    got = met.numbers([b"a", b"new", b"", b"x", b"new"])
    assert got.tolist() == [2, 3, 0, 1, 3] and met.count.tolist() == [3, -1, 9, -1]
    assert met.ids(got).tolist() == [i for w in (b"a", b"new", None, b"x", b"new") for i in ([source.end] if w is None else source.of([w])[0].tolist())]


def test_attention_looks_back_only():
    model = attention.Attention(20, 9, 8, 4)
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (4, 8))
    p = model.chances(x)
    later = x.copy()
    later[:, 5:] = (later[:, 5:] + 1) % 20
    assert np.allclose(model.chances(later)[:, :5], p[:, :5]) and not np.allclose(model.chances(later)[:, 5:], p[:, 5:])
    assert np.allclose(model.chances(x, 3), p[:, 3:], atol=1e-6) and np.allclose(p.sum(axis=2), 1)


def brute_score(model, parts, ids, rows, classes, inside, end, context):
    """One text: each id from its own window, with Python loops."""
    total, step = 0.0, model.width - context
    for t, i in enumerate(ids):
        start = 0 if t < model.width else (-(-(t - model.width + 1) // step)) * step
        before = [rows[end if k == 0 else ids[k - 1]] for k in range(start, t + 1)]
        x = [parts["E"][r].astype(float) + parts["P"][k] for k, r in enumerate(before)]
        q = x[-1] @ parts["Q"]
        s = np.array([q @ (y @ parts["K"]) for y in x]) / math.sqrt(model.dims)
        a = np.exp(s - s.max())
        o = sum(w * (y @ parts["V"]) for w, y in zip(a / a.sum(), x))
        z = (x[-1] + o @ parts["O"]) @ parts["U"] + parts["c"]
        total += z[classes[i]] - z.max() - math.log(np.exp(z - z.max()).sum()) + inside[i]
    return total / math.log(10)


@pytest.mark.parametrize("context", [0, 2, 5])
def test_each_id_is_scored_once(context):
    rng = np.random.default_rng(context)
    model = attention.Attention(12, 5, 6, 4)
    rows, classes = rng.integers(0, 12, 30), rng.integers(0, 5, 30)
    inside = np.log(rng.random(30)).astype(np.float32)
    texts = [rng.integers(0, 30, n) for n in (1, 2, 6, 7, 8, 12, 13, 50, 3)]
    got = attention.score_ids(model, np.concatenate(texts), np.array([len(t) for t in texts]), rows, classes, inside, 29, context, batch=4)
    assert np.allclose(got, [brute_score(model, model.parts, t.tolist(), rows, classes, inside, 29, context) for t in texts], rtol=1e-4)


def test_chances_of_all_ids_add_up_to_one(source):
    rows, classes, inside = attention.tables({5: 100, 300: 40, 7: 3}, source, 11)
    p = np.random.default_rng(0).dirichlet(np.ones(classes.max() + 1))
    assert len(rows) == source.end + 1 and (p[classes] * np.exp(inside.astype(float))).sum() == pytest.approx(1, abs=1e-4)
    assert inside[5] == pytest.approx(0) and inside[source.end] == pytest.approx(0) and set(np.unique(classes)) == set(range(classes.max() + 1))


def base(texts, learned):
    """{n_tokens, n_known, base_score} of texts by plain counting; N."""
    counts = Counter(w for t in learned for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for t in texts:
        own = [counts[w] for w in [*words(t), None]]
        out.append((len(own), sum(c > 0 for c in own), math.fsum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in own)))
    return out, n


def test_query_by_brute_force(spark, sf_dir, texts, monkeypatch):
    monkeypatch.setattr(attention, "HOT", 100)
    got = {r.doc_id: r for r in QUERIES["op11_attention_lm"](spark, sf_dir).collect()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    want, n = base(list(texts.values()), [t for i, t in texts.items() if not out[i]])
    assert got.keys() == texts.keys()
    for i, (tokens, known, score) in zip(texts, want):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], tokens, known, n)
        assert r.base_score == pytest.approx(score, rel=1e-9) and r.score < 0


def test_few_frequent_words_give_the_same_counts(spark, docs, texts):
    want, n = base(list(texts.values()), list(texts.values()))
    for hot in (0, 7, 10**6):
        model = attention.train(docs, F.lit(True), *CODER, sample=64, hot=hot)
        got = {r.doc_id: r for r in attention.scores(docs, model).collect()}
        assert all((got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (*w[:2], n) and got[i].base_score == pytest.approx(w[2], rel=1e-9)
                   for i, w in zip(texts, want))


def test_model_beats_a_model_without_attention(spark, monkeypatch):
    """Held-out texts are likelier than under the classes' frequencies alone, and several shards are averaged."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    monkeypatch.setattr(attention, "SHARD", 100)
    monkeypatch.setattr(attention, "AVERAGED", 3)
    model = attention.train(docs, ~held_out(docs.doc_id, 5, 1), *CODER)
    assert model.losses[-1] < model.losses[0]
    kinds = Counter()
    source = attention.subwords(*CODER)
    rows = docs.where(held_out(docs.doc_id, 5, 1)).collect()
    for r in docs.where(~held_out(docs.doc_id, 5, 1)).select("text").collect():
        for ids in source.of(attention.words_of(r.text)):
            kinds.update(model.classes[ids].tolist())
    total = sum(kinds.values())
    flat = np.array([math.log((kinds[k] + 1) / (total + 200)) for k in range(int(model.classes.max()) + 1)])
    got = {r.doc_id: r.score for r in attention.scores(docs, model).collect()}
    plain = sum(float((flat[model.classes[ids]] + model.inside[ids]).sum()) for r in rows for ids in source.of(attention.words_of(r.text)))
    assert sum(got[r.doc_id] for r in rows) > 0.88 * plain / math.log(10)


def test_odd_rows(spark, odd, odd_rows, empty):
    learns = F.col("doc_id") % 2 == 1
    model = attention.train(odd, learns, *CODER)
    got = attention.scores(odd, model).collect()
    want, n = base([r[1] for r in odd_rows], [r[1] for r in odd_rows if r[0] is not None and r[0] % 2 == 1])
    own = sorted(((r[0], *w[:2], n, round(w[2], 6)) for r, w in zip(odd_rows, want)), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == own
    same = {r.score for r in got if r.doc_id in (4, 5, 6)}
    assert len(same) == 1 and all(math.isfinite(r.score) and r.score < 0 for r in got)
    bare = attention.train(empty, F.lit(True), *CODER)
    assert attention.scores(empty, bare).count() == 0
    cold = attention.scores(odd, bare).collect()
    assert len(cold) == len(odd_rows) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in cold)


def test_windows_hold_every_id_once():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 90, n) for n in (1, 3, 4, 5, 8, 23)]
    for t in texts:
        t[-1] = 99
    found = attention.windows_of(np.concatenate(texts), np.array([len(t) for t in texts]), 4, 99)
    assert len(found) == sum(-(-len(t) // 4) for t in texts) and found[found[:, 1:].min(axis=1) >= 0].shape[1] == 5
    assert [i for row in found[:, 1:].tolist() for i in row if i >= 0] == np.concatenate(texts).tolist()
    before = [i for row in found.tolist() for i, after in zip(row, row[1:]) if after >= 0]
    assert before == [i for t in texts for i in (99, *t[:-1].tolist())]


def test_all_ids_of_all_texts_are_learned_from(spark, docs, texts, source, monkeypatch):
    """Every window of every text, however long, counts in the weights; many sets of weights are averaged level by level."""
    monkeypatch.setattr(attention, "AVERAGED", 2)
    monkeypatch.setattr(attention, "SHARD", 50)
    real, sums = attention.written, []

    def spy(df, name):
        out = real(df, name)
        if name == "weights":
            sums.append(out.agg(F.sum("n")).first()[0])
        return out

    monkeypatch.setattr(attention, "written", spy)
    model = attention.train(docs.repartition(5), F.col("doc_id") % 3 != 0, *CODER, sample=16)
    sizes = [1 + sum(map(len, source.of(attention.words_of(t)))) for i, t in texts.items() if i % 3]
    assert max(sizes) > 2 * model.width and sums == [sum(-(-n // model.width) for n in sizes)] * 3  # 5, 3 and 2 sets
    assert np.isfinite(model.weights).all()
