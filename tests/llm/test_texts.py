"""Secrets, pieces, language, decontamination, toxicity and quality: brute force, round trips, held-out accuracy, odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from statweave.llm import decontaminate, language, pieces, quality, secrets, toxicity
from statweave.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SCHEMA, prose
from tests.oracle_check import connect, difference

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BIG = "/root/testdata/sf0.01"


def made(spark, *texts, lang="en"):
    return spark.createDataFrame([(k, t, lang, "s", 1) for k, t in enumerate(texts)], SCHEMA)


# --- secrets ----------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def test_base_spans_by_brute_force(spark):
    rng = random.Random(3)
    bits = ["password", "PassWd", "token", "api_key", "apikey", ":", "=", " ", '"', "AKIA", "AKIAAKIA0123", "abcdef", "0123456789", "XYZ", "\n", "é☃", "=", "secret"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(400)]
    rows = secrets.scan(made(spark, *texts)).collect()
    for r in rows:
        want = base_spans(texts[r.doc_id])
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in want) for n in range(3)]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_weak_parts_only_with_complements(spark):
    key, name, far = "Zx9Qw8Er7Ty6Ui5Op4As3", "ABCD1234EFGH", " word" * 60
    rows = secrets.scan(made(spark, f"{key} alone", f"{name} and {key}", f"{key}{far}{name}", f"{key} at https://host.example/x", "https://host.example/x only")).orderBy("doc_id").collect()
    assert [r.spans for r in rows] == ["", "id:0:12,key:17:38", "", "key:0:21,endpoint:25:47", ""]
    masked = secrets.without_secrets(made(spark, f"{name} and {key} x", "token=abcdefghijklmnop tail", None, "clean")).orderBy("doc_id").collect()
    assert [r.text for r in masked] == ["[secret] and [secret] x", "[secret] tail", None, "clean"]


def test_long_parts_belong_together_by_their_nearest_ends(spark):
    """The distance of two parts runs from the end of one to the start of the other, whatever their lengths."""
    name, scope = "AB12CD34EF56", secrets.SCOPE
    for size in (30, 300, 1500):
        key = ("aB3" * size)[:size]
        near = [f"{key} {name}", f"{name} {key}", f"{key}{' ' * scope}{name}", f"{name}{'.' * scope}{key}", f"{key} https://host.example/x"]
        far = [f"{key}{' ' * (scope + 1)}{name}", f"{name}{'.' * (scope + 1)}{key}"]
        rows = secrets.scan(made(spark, *near, *far)).orderBy("doc_id").collect()
        assert [len(r.linked) for r in rows] == [2] * len(near) + [0] * len(far)
        masked = secrets.without_secrets(made(spark, *near, *far)).orderBy("doc_id").collect()
        assert all(key not in r.text for r in masked[:len(near)]) and [r.text for r in masked[len(near):]] == far


def test_links_by_brute_force(spark):
    rng = random.Random(8)
    bits = ["AB12CD34EF56", "aB3" * 9, "xY7" * 110, "https://host.example/x", "token=abcdefghijkl1", "AKIA" + "Q7" * 8, "word " * 19, "." * 97, " ", "word " * 41]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", "; "]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    rows = secrets.scan(made(spark, *texts)).collect()
    kinds = secrets.KINDS
    needs = {"id": ("assign", "hex", "key"), "key": ("access", "id", "endpoint"), "endpoint": ("assign", "hex", "key", "access", "id")}
    for r in rows:
        spans = [(kinds.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        text = texts[r.doc_id]
        base = base_spans(text)
        weak = []
        for kind, pattern in secrets.WEAK:
            for m in re.finditer(pattern, text):
                mixed = re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
                if (kind == "endpoint" or mixed) and not any(a < m.end() and m.start() < b for a, _, b in base):
                    weak.append((kinds.index(kind), m.start(), m.end()))
        parts = weak + [(k, a, b) for a, k, b in base]
        want = {w for w in weak if any(kinds[o[0]] in needs[kinds[w[0]]] and max(w[1], o[1]) - min(w[2], o[2]) <= secrets.SCOPE for o in parts)}
        assert {s for s in spans if s[0] > 2} == want


def test_secrets_equal_sql_and_stay_on_the_jvm(spark):
    assert difference(spark, connect(BIG), BIG, QUERIES["op2_secret_scan"], ORACLES["op2_secret_scan"]) is None
    plan = QUERIES["op2_secret_scan"](spark, BIG)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


# --- pieces -----------------------------------------------------------------------


def test_words_against_the_public_library_for_unigram_models(texts):
    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1  # the same pieces and scores, read as a unigram model
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()), pieces.Pieces(MODEL)
    words = sorted({w for t in texts.values() for w in t.split()})  # in longer texts the library's 32-bit sums lose digits
    words = [w for w in words if all(c in own.ids for c in w)]
    assert len(words) > 5000
    differ = [w for ids, w in zip(own.encode(words), words) if np.frombuffer(ids, "<u2").tolist() != library.encode(w)]
    for word in differ:  # never a worse sum of scores than the library's
        scores = [sum(own.scores[i] for i in ids) for ids in (np.frombuffer(own.encode([word])[0], "<u2").tolist(), library.encode(word))]
        assert scores[0] >= scores[1], word
    assert len(differ) < len(words) / 100


def test_pieces_by_brute_force_and_round_trip():
    own = pieces.Pieces(MODEL)
    rng = random.Random(7)

    def best(word):
        top = -np.inf
        for cuts in itertools.product((0, 1), repeat=len(word) - 1):
            parts, start = [], 0
            for k, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(word[start:k])
                    start = k
            if all(p in own.ids or len(p) == 1 for p in parts):
                top = max(top, sum(own.scores[own.ids[p]] if p in own.ids else own.floor for p in parts))
        return top

    words = ["▁" + "".join(rng.choices("theinré☃", k=rng.randint(1, 8))) for _ in range(60)]
    for word, ids in zip(words, own.segment(words)):
        found = np.frombuffer(ids, "<u2").tolist()
        score = sum(own.scores[i] if i not in own.bytes.values() else 0 for i in found) + own.floor * sum(c not in own.ids for c in word)
        assert score == pytest.approx(best(word))
    odd = ["", " ", "  a  b ", "\n\t", "é☃漢字\x00", "x" * 1000, "a" * 300 + "☃"] + ["".join(rng.choices("ab é☃\n ", k=30)) for _ in range(300)]
    assert [own.decode(np.frombuffer(x, "<u2")) for x in own.encode(odd)] == odd
    assert own._alone("▁thethinreé☃") == own._together(["▁thethinreé☃"], 12)[0]


def test_pieces_query_and_odd_rows(spark, sf_dir, odd, odd_rows, empty):
    assert QUERIES["op3_sentencepiece"](spark, sf_dir).where("NOT round_trip").count() == 0
    out = pieces.encode(odd, MODEL)
    assert out.count() == len(odd_rows) and out.where("NOT round_trip").select("doc_id").collect() == [(10,)]  # it has U+2581
    assert out.where("doc_id IN (4, 5) AND n_tokens = 0 AND ids_crc32 = 0 AND size(ids) = 0").count() == 2
    kept = pieces.with_tokens(odd, MODEL)
    assert kept.columns == [*odd.columns, "tokens"] and kept.where("doc_id = 4 AND text IS NULL AND size(tokens) = 0").count() == 1
    assert pieces.encode(empty, MODEL).count() == 0 and pieces.with_tokens(empty, MODEL).count() == 0


def test_pieces_query_returns_ids_that_decode_to_the_text(spark, sf_dir, texts):
    own, rows = pieces.Pieces(MODEL), QUERIES["op3_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(r.ids, "<u4")
        assert own.decode(ids) == texts[r.doc_id] and (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


# --- language ---------------------------------------------------------------------


def test_phrases_by_brute_force(spark):
    learned = {"a": "abracadabra ab ba", "b": "banana nab cab"}
    df = spark.createDataFrame([(k, t, l, "s", 1) for k, (l, t) in enumerate(learned.items())], SCHEMA)
    parser, rng = language.train(df), random.Random(1)

    def phrases(sample, text):
        n = at = 0
        while at < len(text):
            end = at
            while end < len(text) and text[at:end + 1] in sample:
                end += 1
            at, n = max(end, at + 1), n + 1
        return n

    for _ in range(200):
        cut = language.letters("".join(rng.choices("abcrdnx ,", k=rng.randint(1, 60))))
        if len(cut):
            text = "".join(map(chr, cut))
            assert parser.phrases([cut])[0].tolist() == [phrases(" " + learned[k], text) for k in parser.languages]


def test_signs_beyond_the_first_plane_are_letters_only_if_alphabetic(spark):
    parser = language.train(spark.createDataFrame([(1, "good day to you all", "en", "s", 1), (2, "guten tag euch allen", "de", "s", 1)], SCHEMA))
    rows = language.identify(made(spark, "\U0001F600\U0001F680 \U0001D7D8", "good \U0001F600\U0001F680\U0001F600 day", "\U00020000 \U00010428"), parser).orderBy("doc_id").collect()
    assert (rows[0].lang_pred, rows[0].score) == (language.NONE, 0.0) and rows[1].lang_pred == "en"
    assert language.letters("good \U0001F600\U0001F680 day").tolist() == language.letters("good day").tolist()
    assert language.letters("\U00020000 \U00010428\U0001F600").tolist() == [0x20000, 32, 0x10428, 32]


def test_every_learned_letter_is_told_apart(spark):
    """Alphabets far beyond the columns of the tables, one of them astral: phrases by brute force."""
    rng = random.Random(4)
    signs = {"a": "abc ", "j": [chr(0x4E00 + k) for k in range(900)], "z": [chr(0x4E00 + k) for k in range(600, 1500)] + [chr(0x20000 + k) for k in range(300)]}
    learned = {k: "".join(rng.choices(own, k=3000)) for k, own in signs.items()}
    parser = language.train(spark.createDataFrame([(k, t, l, "s", 1) for k, (l, t) in enumerate(learned.items())], SCHEMA))
    samples = {k: " " + "".join(map(chr, language.letters(t))) for k, t in learned.items()}
    cuts = []
    for k, text in learned.items():
        for _ in range(30):
            parts = [text[at:at + rng.randint(1, 40)] for at in (rng.randrange(len(text)) for _ in range(4))]
            cuts.append(("".join(parts) + "".join(rng.choices(signs[rng.choice("ajz")], k=9)) + "\u9FA0\U0002A000")[:language.STRETCH])

    def phrases(sample, text):
        n = at = 0
        while at < len(text):
            end = at
            while end < len(text) and text[at:end + 1] in sample:
                end += 1
            at, n = max(end, at + 1), n + 1
        return n

    cut = [language.letters(t) for t in cuts]
    want = [[phrases(samples[k], "".join(map(chr, c))) for k in parser.languages] for c in cut]
    assert parser.phrases(cut).tolist() == want
    rows = language.identify(made(spark, *cuts), parser).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == [k for k in learned for _ in range(30)]


def test_language_accuracy_and_odd_rows(spark, odd, odd_rows, empty):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    out = QUERIES["op4_language_id"](spark, BIG).join(docs, "doc_id").where("held_out")
    assert out.where("lang_pred = lang").count() / out.count() > 0.99
    parser = language.train(docs)
    rows = language.identify(odd, parser).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if r.lang_pred == language.NONE} == {4, 5, 6}
    assert language.identify(empty, parser).count() == 0 and language.train(empty).languages == []
    assert language.identify(odd, language.train(empty)).where("lang_pred <> 'und' OR score <> 0").count() == 0


# --- decontamination --------------------------------------------------------------


def test_decontamination_by_brute_force(spark, sf_dir, texts):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontamination"](spark, sf_dir).collect()}
    indexes = [i.value for group in decontaminate.indexes(spark.read.parquet(f"{sf_dir}/benchmark.parquet")) for i in group]
    want = set()
    for doc, text in texts.items():
        words = decontaminate.words_of(text)
        for index in indexes:
            for k in range(len(words) // index.stretch + 1):
                passage = words[k * index.stretch:(k + 2) * index.stretch]
                said, runs = set(passage), decontaminate._runs_all(passage)
                for item in itertools.chain(*index.blocks):
                    if sum(x for w, x in item.weights.items() if w in said) >= decontaminate.THRESHOLD and all(
                            len(p & runs) / len(p) >= decontaminate.OVERLAP for p in (item.question, item.answer)):
                        want.add((doc, item.item_id))
    assert got == want and got


def test_decontamination_of_odd_rows_and_long_items(spark, odd, empty):
    item = prose(50, 300) + ". " + prose(51, 20)
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (None, "x y z"), (3, ""), (4, prose(52, 12))], "item_id long, text string")
    docs = made(spark, prose(60, 900) + " " + item.upper() + " " + prose(61, 5000), prose(62, 3000), None, "", prose(52, 12))
    for per in (20_000, 1):
        found = [i for group in decontaminate.indexes(items, per_index=per) for i in group]
        assert sorted(i.value.stretch for i in found) == [64, 512]
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == {(0, 1), (4, 4)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {1, 2, 3}
    none = items.where("false")
    assert decontaminate.contaminated(odd, none).count() == 0 and decontaminate.drop_contaminated(odd, none).columns == odd.columns
    assert decontaminate.contaminated(empty, items).count() == 0


def test_a_text_longer_than_a_round_of_weighing(monkeypatch, spark):
    items = spark.createDataFrame([(1, prose(70, 40))], "item_id long, text string")
    index = decontaminate.indexes(items)[0][0].value
    words = decontaminate.words_of(prose(71, 2000) + " " + prose(70, 40) + " " + prose(72, 2000))
    whole = index.reachable([words, words[:50]])
    monkeypatch.setattr(decontaminate, "CELLS", 7)
    assert sorted(set(index.reachable([words, words[:50]]))) == sorted(whole) and whole


# --- toxicity ---------------------------------------------------------------------


def test_marginals_by_brute_force():
    rng = np.random.default_rng(3)
    field = toxicity.Field({"a": 0, "b": 1}, np.array([2.0, -0.5]), -1.0, rng.normal(size=(2, 2)), -0.7, np.zeros(3))
    for tokens in ([2, 0, 2, 2, 1, 2], [0], [2, 2, 0], [0, 1, 2], [1, 2, 2, 2, 0]):
        emit = [[0.0, field.background if t == 2 else field.weights[t]] for t in tokens]
        total, toxic = 0.0, np.zeros(len(tokens))
        for path in itertools.product((0, 1), repeat=len(tokens)):
            score = field.start * path[0] + sum(e[s] for e, s in zip(emit, path)) + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
            total += np.exp(score)
            toxic += np.exp(score) * np.array(path)
        at = [k for k, t in enumerate(tokens) if t < 2]
        gaps = [b - a - 1 for a, b in zip([-1, *at], at)]
        assert field.marginals([tokens[k] for k in at], gaps, len(tokens) - at[-1] - 1) == pytest.approx((toxic / total)[at])


def test_stretches_hold_all_cues():
    rng = np.random.default_rng(6)
    for size in (1, 5, 23, 24, 25, 400):
        for cues in (0, 1, 9, size):
            tokens = np.full(size, 7)
            tokens[rng.choice(size, min(size, cues), replace=False)] = 3
            found = toxicity._stretches(tokens, 7)
            held = [k for low, high in found for k in range(low, high)]
            assert len(held) == len(set(held)) and all(0 < high - low <= toxicity.SEGMENT for low, high in found)
            for at in np.flatnonzero(tokens < 7):
                assert set(range(max(0, at - 12), min(size, at + 12))) <= set(held)


def test_short_documents_teach_the_field():
    """Texts of a few tokens only, and cues that stand late in a text, give their words weights."""
    toxic = np.array([1] * 30 + [0] * 30)
    short = [["you", "late" if k % 2 else "soon"] for k in range(30)] + [["good", "day"]] * 30
    long = [["word"] * 300 + ["soon"] * 5 + ["word"] * 300 + ["late"] for _ in range(30)] + [["word"] * 600] * 30
    for texts in (short, long):
        field = toxicity.Field({"late": 0, "soon": 1}, np.zeros(2), 0.0, np.zeros((2, 2)), 0.0, np.zeros(3))
        weights, background, *_ = toxicity._fit_field(texts, toxic, field)
        assert (weights > 1).all() and (weights > background + 1).all()


def test_padding_changes_nothing():
    """A short text has the weights that a plain gradient over its own tokens finds."""
    texts, toxic = [["bad", "x", "x"], ["x", "bad"], ["x", "x", "x", "x"]] * 10, np.array([1, 1, 0] * 10)
    field = toxicity.Field({"bad": 0}, np.zeros(1), 0.0, np.zeros((2, 2)), 0.0, np.zeros(3))
    w, background, steps, start = toxicity._fit_field(texts, toxic, field)

    def likelihood(w0, w1, s, b):
        total = -0.25 * (w0**2 + w1**2 + (s**2).sum() + b**2)
        for words, label in zip(texts, toxic):
            emit = [w0 if x == "bad" else w1 for x in words]
            states = [int(x == "bad" and label) for x in words]
            score = lambda path: b * path[0] + sum(e * k for e, k in zip(emit, path)) + sum(s[p, q] for p, q in zip(path, path[1:]))
            total += score(states) - np.log(sum(np.exp(score(p)) for p in itertools.product((0, 1), repeat=len(words))))
        return total

    best = likelihood(w[0], background, steps, start)
    rng = np.random.default_rng(1)
    for _ in range(40):
        move = rng.normal(0, 0.3, 5)
        other = steps + np.array([[0, move[2]], [move[3], move[4]]])
        assert likelihood(w[0] + move[0], background + move[1], other, start) < best + 0.02


def test_toxicity_accuracy_spans_and_odd_rows(spark, odd, odd_rows, empty):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    out = QUERIES["op8_toxicity"](spark, BIG).join(labels, "doc_id").where("held_out")
    assert out.where("predicted = toxic").count() / out.count() > 0.9
    field = toxicity.train(docs, labels)
    score, spans = field.judge("You idiot, Moron and stupid clown!")
    assert score > 0.5 and [(a, b) for a, b, _ in spans] == [(4, 9), (11, 16), (21, 27), (28, 33)]
    rows = toxicity.score(odd, field).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.drop_toxic(odd, field).columns == odd.columns and toxicity.score(empty, field).count() == 0
    flat = toxicity.train(docs, labels.where("toxic = 0"))
    assert not flat.cues and toxicity.score(odd, flat).where("predicted = 1").count() == 0


# --- quality ----------------------------------------------------------------------


def test_quality_accuracy_and_odd_rows(spark, odd, odd_rows, empty):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    out = QUERIES["op9_quality"](spark, BIG).join(labels, "doc_id").where(toxicity.held_out(labels.doc_id))
    assert out.where("keep = (quality = 1)").count() / out.count() > 0.95
    model = quality.train(docs, labels)
    rows = quality.assess(odd, model, odd.source, odd.lang).collect()
    assert len(rows) == len(odd_rows) and all(0 < r.posterior < 1 for r in rows)
    assert quality.assess(empty, model, empty.source, empty.lang).count() == 0
    assert quality.assess(odd, quality.train(docs, labels.where("false")), odd.source, odd.lang).count() == len(odd_rows)


def test_sparse_paths_lean_on_their_site(spark):
    """Rates of groups by hand: a single document has the rate of its site, shrunk to the whole."""
    rows = [(k, "good", "en", "big", 1) for k in range(50)] + [(100 + k, "bad", "en", "poor", 1) for k in range(50)] + [(200, "good", "xx", "poor", 1)]

    class Known(quality.Classifier):
        def chance(self, texts):
            return np.array([0.9 if t == "good" else 0.1 for t in texts])

    model = Known(np.zeros(1), np.ones(1), np.zeros(1), 0.5)
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in quality.assess(df, model, df.source, df.lang).collect()}
    assert out[0].posterior > 0.9 and out[100].posterior < 0.1
    assert out[200].evidence == 0.9 and out[200].site_rate < 0.3 and out[200].posterior < out[200].evidence
