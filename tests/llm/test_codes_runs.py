"""Vector codes and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statweave.llm import codes, periodic
from statweave.llm.queries import ORACLES, QUERIES
from tests.llm.test_layout import BIG
from tests.oracle_check import connect, difference


# --- vector codes -----------------------------------------------------------------


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """{(id, label, vector): (code, error)} and the codebooks, with Python's numbers only."""
    whole = []
    for i, v, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, label, tuple(int(np.floor(max(-2.0**53, min(2.0**53, float(x) * 256)))) for x in v)))
    known = sorted((i, -len(v)) for i, _, v in whole if i is not None)
    if not known or -known[0][1] % parts or not known[0][1]:
        return [(i, label, None, None) for i, label, _ in whole], None
    dims = -known[0][1]
    size, fit = dims // parts, [v for _, _, v in whole if len(v) == dims]
    least = {}
    for i, _, v in sorted((w for w in whole if w[0] is not None and len(w[2]) == dims), key=lambda w: (w[0], w[2])):
        least.setdefault(i, v)
    books = [[list(v[p * size:p * size + size]) for _, v in sorted(least.items())[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = {}
            for v in fit:
                own.setdefault(nearest(v[p * size:p * size + size], book)[1], []).append(v[p * size:p * size + size])
            for k, some in own.items():
                book[k] = [sum(c) // len(some) for c in zip(*some)]
    out = []
    for i, label, v in whole:
        found = [nearest(v[p * size:p * size + size], books[p]) for p in range(parts)] if len(v) == dims else None
        out.append((i, label, "".join(f"{k:02x}" for _, k in found) if found else None, sum(d for d, _ in found) if found else None))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def check_codes(got, rows):
    want, sha = brute_codes(rows)
    totals = {}
    for _, label, _, error in want:
        totals[label] = totals.get(label, 0) + error if error is not None and totals.get(label, 0) is not None else totals.get(label)
    longs = lambda x: x if x is None or abs(x) < 1 << 63 else None
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=repr) == sorted(
        ((i, c, longs(e), longs(totals[label]), sha) for i, label, c, e in want), key=repr)


def test_code_query_by_sql(spark):
    assert difference(spark, connect(BIG), BIG, QUERIES["op12_vector_codes"], ORACLES["op12_vector_codes"]) is None


VECTORS = "vec_id long, embedding array<float>, label int"


def test_codes_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(k // 2 * 3, [rng.choice([-0.5, 0.0, 0.25, 0.004, 1.5]) for _ in range(32)], rng.choice([0, 1, None])) for k in range(300)]
    rows += [(None, rows[0][1], 1), (5000, None, 1), (5001, [None] * 32, 1), (5002, [float("nan")] * 32, 0), (5003, [float("inf")] * 32, 0),
             rows[7], rows[7], (5004, [0.5] * 16, 2), (5005, [], 2), (5006, [-3.0] * 31 + [7.5], 3), (5007, [1e30] * 32, 4)]
    df = spark.createDataFrame(rows, VECTORS)
    clash = df.selectExpr("*", "'x' AS id", "'x' AS v", "'x' AS code", "'x' AS error", "'x' AS salt", "'x' AS total", "'x' AS wide")
    check_codes(codes.compressed(clash).collect(), rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None, 2)], [(1, [1.0] * 15, 2), (2, [1.0] * 16, 2)], [(None, [1.0] * 16, 2)], [(1, [1.0, -1.0] * 8, None)], [(1, [], None)],
])
def test_codes_of_few_rows(spark, rows):
    check_codes(codes.compressed(spark.createDataFrame(rows, VECTORS)).collect(), rows)


def test_trie_shares_prefixes_and_keeps_ties(monkeypatch):
    rng = np.random.default_rng(2)
    for nodes in (1, 3, 4096):
        monkeypatch.setattr(codes, "NODES", nodes)
        for far in (3, 1 << 40):
            parts = np.unique(rng.integers(-far, far + 1, (200, 4)), axis=0)
            entries = rng.integers(-far, far + 1, (9, 4))
            entries[5] = entries[2]
            trie = codes.Trie(parts, entries)
            gaps = ((parts[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
            assert trie.code.tolist() == gaps.argmin(axis=1).tolist() and trie.error.tolist() == gaps.min(axis=1).tolist()
            prefixes = sum(len(np.unique(parts[:, :d], axis=0)) for d in range(1, 5))
            assert trie.shared == prefixes and (far > 3 or prefixes < parts.size)


# --- periodic runs ----------------------------------------------------------------


def brute_runs(x):
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs_of(texts):
    text, start, length, period = periodic.all_runs([np.array(t, np.int64) for t in texts])
    return [sorted(zip(start[text == k].tolist(), length[text == k].tolist(), period[text == k].tolist())) for k in range(len(texts))]


blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=30), st.integers(1, 6), st.integers(0, 29)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=3))
def test_runs_by_brute_force(given_texts):
    texts = [[w for block, times, more in text for w in block * times + block[:more]] for text in given_texts]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_runs_in_very_repetitive_texts():
    a, fib = [0], [1]
    while len(fib) < 600:
        a, fib = fib, fib + a
    morse = [bin(k).count("1") % 2 for k in range(1024)]
    nested = (([0] * 20 + [1]) * 6 + [2]) * 5
    touching = [0, 1] * 90 + [0] + [0, 1] * 80
    texts = [[0] * 1500, fib, morse, nested, touching, touching[::-1], [0, 1, 0] * 200, [], [5], list(range(700)) * 2]
    assert runs_of(texts) == [brute_runs(t) for t in texts]
    assert runs_of([[0] * 200_000, [0, 1] * 100_001]) == [[(0, 200_000, 1)], [(0, 200_002, 2)]]


def brute_row(doc_id, text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [r for r in brute_runs(words) if r[1] >= max(12, 2 * r[2])]
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[1] and best[1] * 1000 // best[2],
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def test_run_query_by_brute_force(spark, sf_dir, docs, texts):
    got = QUERIES["op13_periodic_runs"](spark, sf_dir).collect()
    short = {i for i, t in texts.items() if len((t or "").split()) < 1500}
    assert len(got) == len(texts) and len(short) > 150 and any(r.start is not None for r in got)
    assert {tuple(r) for r in got if r.doc_id in short} == {brute_row(i, texts[i]) for i in short}


def test_runs_of_odd_rows(spark, odd, odd_rows, empty, monkeypatch):
    more = [(20, "x " * 40, "en", "a", 1), (21, "a b " * 5 + "a", "en", "a", 1), (10, "ab cd\x0bef\x1f " * 30, "en", "a", 1)]
    rows = odd.limit(0).select(*odd.columns[:5]).union(spark.createDataFrame(odd_rows + more, odd.select(*odd.columns[:5]).schema))
    want = sorted((brute_row(r[0], r[1]) for r in odd_rows + more if len((r[1] or "").split()) < 5000), key=repr)
    for slab in (1, 300_000):
        monkeypatch.setattr(periodic, "SLAB", slab)
        got = [tuple(r)[:8] for r in periodic.periodic_runs(rows, rewrite=True).collect()]
        assert len(got) == len(odd_rows) + len(more)
        assert sorted((g for g in got if g[0] != 7), key=repr) == want
    assert periodic.periodic_runs(odd, rewrite=True).count() == len(odd_rows)
    assert periodic.periodic_runs(empty).count() == 0
