"""Toxic spans and document scores from a linear-chain conditional random field.

Labels are per document, so token labels are derived first: a word is a cue if it stands in
toxic documents far more often than in others, counted by distinct neighbours of its first
place in each document so that copies of one text count once. Cues in toxic documents are the toxic tokens that the field learns
from; it has two states, one weight per cue and weights for steps between states.

Between cues lie runs of background tokens with the same potentials. A run of g tokens is
the g-th power of one 2 x 2 matrix, so forward and backward messages jump from cue to cue
and marginals are those of a pass over every token. A document's score is a logistic
function of its marginals, fitted on the labelled sample and set to the true label rate.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

TOKEN = re.compile(r"\w+")
SAMPLE, CLEAN = 600, 1500  # toxic and clean labelled documents that are learned from, at most
CUES = 500  # cue words kept, at most
MIN_CONTEXTS, MIN_SHARE, MIN_RATIO = 4, 0.01, 20.0
SEGMENT = 24  # tokens of a training sequence
RESULT = "struct<score:double,spans:array<struct<start:int,end:int,p:double>>>"


@dataclass
class Field:
    """Cue words with their weights for the toxic state; background, step and score weights."""

    cues: dict[str, int]
    weights: np.ndarray  # of the cues
    background: float
    steps: np.ndarray  # [from, to]; 0 is clean, 1 is toxic
    start: float
    scoring: np.ndarray  # constant, log(1 + expected toxic tokens), largest marginal

    def hits(self, words: list[str]) -> dict[str, int]:
        """The cues among a text's words; most texts have none."""
        return {w: self.cues[w] for w in self.cues.keys() & set(words)} if self.cues else {}

    def _run(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Projections and ratio of eigenvalues of the background matrix: its g-th power is first + ratio**g * second, scaled."""
        m = np.exp(self.steps + np.array([0.0, self.background]))
        values, vectors = np.linalg.eig(m)
        values, vectors = values.real, vectors.real
        top = int(np.argmax(values))
        first = np.outer(vectors[:, top], np.linalg.inv(vectors)[top])
        return first, np.eye(2) - first, float(values[1 - top] / values[top])

    def marginals(self, cues: list[int], gaps: list[int], after: int) -> np.ndarray:
        """Chance of the toxic state at each cue; gaps[k] background tokens lie before cue k, `after` follow the last."""
        first, second, ratio = self._run()
        power = lambda g: first + ratio**g * second
        steps = np.exp(self.steps)
        emit = [np.array([1.0, math.exp(self.weights[c])]) for c in cues]
        begin = np.array([1.0, math.exp(self.start)])
        forward, backward = [], [np.ones(2)]
        for k, e in enumerate(emit):
            if k:
                message = forward[-1] @ power(gaps[k]) @ steps
            elif gaps[0]:
                message = (begin * np.array([1.0, math.exp(self.background)])) @ power(gaps[0] - 1) @ steps
            else:
                message = begin
            message = message * e
            forward.append(message / message.sum())
        backward[0] = power(after) @ np.ones(2)
        for k in range(len(emit) - 1, 0, -1):
            message = power(gaps[k]) @ (steps @ (emit[k] * backward[-1]))
            backward.append(message / message.sum())
        both = np.array(forward) * np.array(backward[::-1])
        return both[:, 1] / both.sum(axis=1)

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and start, end (code points) and marginal of its likely toxic tokens."""
        found = []
        if text and (cues := self.hits([w.lower() for w in TOKEN.findall(text)])):
            found = [(k, cues[w], m.start(), m.end()) for k, m in enumerate(TOKEN.finditer(text)) if (w := m[0].lower()) in cues]
        if not found:
            return self.score(np.zeros(0)), []
        places = [k for k, *_ in found]
        count = places[-1] + 1 + sum(1 for _ in TOKEN.finditer(text, found[-1][3]))
        p = self.marginals([c for _, c, *_ in found], [b - a - 1 for a, b in zip([-1, *places], places)], count - places[-1] - 1)
        return self.score(p), [(s, e, float(x)) for (_, _, s, e), x in zip(found, p) if x >= 0.5]

    def score(self, p: np.ndarray) -> float:
        z = float(self.scoring @ _summary(p))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _summary(p: np.ndarray) -> np.ndarray:
    return np.array([1.0, math.log1p(p.sum()), p.max() if len(p) else 0.0])


def _cues(texts: list[list[str]], toxic: np.ndarray, most: int = CUES) -> dict[str, int]:
    seen: dict[str, tuple[set, set]] = defaultdict(lambda: (set(), set()))
    for words, label in zip(texts, toxic):
        first = {w: c for *c, w in zip(["", *words][-2::-1], [*words[1:], ""][::-1], words[::-1])}
        for word, around in first.items():  # one vote of a document, one of all its copies
            seen[word][label].add(hash(tuple(around)))
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    least = max(MIN_CONTEXTS, n[1] * MIN_SHARE)
    ratio = {w: (len(t) / n[1]) / ((len(c) + 0.5) / n[0]) for w, (c, t) in seen.items() if len(t) >= least}
    best = sorted((w for w in ratio if ratio[w] >= MIN_RATIO), key=lambda w: (-ratio[w], w))[:most]
    return {w: k for k, w in enumerate(sorted(best))}


def _stretches(tokens: np.ndarray, none: int) -> list[tuple[int, int]]:
    """Pieces of SEGMENT tokens at most that hold all cues with their surroundings, and one from the middle of the text."""
    half, out = SEGMENT // 2, []
    for at in np.flatnonzero(tokens < none).tolist():
        low, high = max(0, at - half), min(len(tokens), at + half)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    middle = len(tokens) // 2
    if not any(low <= middle < high for low, high in out):
        out.append((max(0, middle - half), min(len(tokens), middle + half)))
    return [(k, min(k + SEGMENT, high)) for low, high in out for k in range(low, high, SEGMENT)]


def _fit_field(texts: list[list[str]], toxic: np.ndarray, field: Field) -> tuple[np.ndarray, float, np.ndarray, float]:
    """Weights by gradient ascent on the likelihood of the derived labels, over stretches around all cues and elsewhere.

    Stretches that overlap are one; shorter ones, such as whole short texts, are filled up
    and the filling is masked.
    """
    none, rows, labels, lengths = len(field.cues), [], [], []
    for words, label in zip(texts, toxic):
        cues = field.hits(words)
        tokens = np.array([cues.get(w, none) for w in words] or [none])
        for low, high in _stretches(tokens, none):
            piece = np.full(SEGMENT, none)
            piece[:high - low] = tokens[low:high]
            rows.append(piece)
            labels.append((piece < none) & bool(label))
            lengths.append(high - low)
    if not rows:
        return np.zeros(none), -8.0, np.zeros((2, 2)), -4.0
    x, y = np.array(rows), np.array(labels).astype(int)
    real_at = np.arange(SEGMENT) < np.array(lengths)[:, None]
    stepped = real_at[:, 1:]
    lanes = np.arange(len(x))
    w, s, b = np.zeros(none + 1), np.zeros((2, 2)), np.zeros(1)
    params, slow, fast = [w, s, b], [0, 0, 0], [0, 0, 0]
    for turn in range(1, 151):
        emit = np.stack([np.ones(x.shape), np.exp(w[x])], axis=2)
        step = np.exp(s)
        forward = np.empty((*x.shape, 2))
        backward = np.ones((*x.shape, 2))
        forward[:, 0] = emit[:, 0] * np.array([1.0, np.exp(b[0])])
        forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, SEGMENT):
            forward[:, t] = (forward[:, t - 1] @ step) * emit[:, t]
            forward[:, t] /= forward[:, t].sum(axis=1, keepdims=True)
            forward[~real_at[:, t], t] = forward[~real_at[:, t], t - 1]
        for t in range(SEGMENT - 2, -1, -1):
            backward[:, t] = (emit[:, t + 1] * backward[:, t + 1]) @ step.T
            backward[:, t] /= backward[:, t].sum(axis=1, keepdims=True)
            backward[~real_at[:, t + 1], t] = 1.0
        p = forward * backward
        p /= p.sum(axis=2, keepdims=True)
        pair = forward[:, :-1, :, None] * step * (emit[:, 1:] * backward[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        real = np.zeros((2, 2))
        np.add.at(real, (y[:, :-1][stepped], y[:, 1:][stepped]), 1)
        up = [np.bincount(x.ravel(), ((y - p[:, :, 1]) * real_at).ravel(), none + 1) - 0.5 * w, real - pair[stepped].sum(axis=0) - 0.5 * s,
              np.array([(y[:, 0] - p[lanes, 0, 1]).sum()]) - 0.5 * b]
        up[1][0, 0] = 0.0  # staying clean is the reference
        for k, g in enumerate(up):  # each weight moves by a step of its own size
            slow[k] = 0.9 * slow[k] + 0.1 * g
            fast[k] = 0.99 * fast[k] + 0.01 * g * g
            params[k] += 0.15 * (slow[k] / (1 - 0.9**turn)) / (np.sqrt(fast[k] / (1 - 0.99**turn)) + 1e-8)
    return w[:none].copy(), float(w[none]), s, float(b[0])


def _fit_score(field: Field, texts: list[list[str]], toxic: np.ndarray, rate: float) -> np.ndarray:
    """Logistic weights over the marginals of the sample, moved to the label rate of all labelled rows."""
    def of(words: list[str]) -> np.ndarray:
        cues = field.hits(words)
        hits = [(k, cues[w]) for k, w in enumerate(words) if w in cues]
        places = [k for k, _ in hits]
        return field.marginals([c for _, c in hits], [b - a - 1 for a, b in zip([-1, *places], places)], 0) if hits else np.zeros(0)

    x = np.array([_summary(of(t)) for t in texts])
    weight = np.where(toxic == 1, rate / max(toxic.mean(), 1e-9), (1 - rate) / max(1 - toxic.mean(), 1e-9))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-6] + [0.05] * (len(w) - 1))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(curve, x.T @ (weight * (toxic - p)) - ridge @ w)
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, clean: int = CLEAN, most_cues: int = CUES) -> Field:
    """Learn from at most `sample` toxic and `clean` other labelled documents, chosen by a hash of their id.

    The field keeps the `most_cues` words that tell toxic documents best, and learns from the
    surroundings of every place where one of them stands, in whole texts of any length.

    Only labelled ids are picked from `labels`; their texts are the only thing brought to the
    driver. Ids with a NULL label are left out; repeated ids count once (toxic wins, and of several texts the least). Without
    rows of both labels nothing is learned: the score is then the rate of the label.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(label_col).cast("int")).alias("label"))
    counts = dict(marked.groupBy("label").count().collect())
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.0
    flat = Field({}, np.zeros(0), 0.0, np.zeros((2, 2)), 0.0,
                 np.array([math.log((rate + 1e-6) / (1 - rate + 1e-6)), 0.0, 0.0]))
    if not counts.get(0) or not counts.get(1):
        return flat
    few = [marked.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(n) for k, n in ((0, clean), (1, sample))]
    chosen = few[0].union(few[1])  # at most `sample` and `clean` rows of an id and a label
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").join(
        F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")).orderBy("id").collect()
    texts, toxic = [r["text"] for r in rows], np.array([r["label"] for r in rows], int)
    if not 0 < toxic.sum() < len(toxic):
        return flat
    words = [[w.lower() for w in TOKEN.findall(t)] for t in texts]
    cues = _cues(words, toxic, most_cues)
    if not cues:
        return flat
    field = Field(cues, np.zeros(len(cues)), 0.0, np.zeros((2, 2)), 0.0, np.zeros(3))
    field.weights, field.background, field.steps, field.start = _fit_field(words, toxic, field)
    field.scoring = _fit_score(field, words, toxic, rate)
    return field


def judged(text: Column, field: Field) -> Column:
    """struct(score, spans) of a text column; every text gets a score, NULL and empty ones too."""

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        found = [field.judge(t) for some in slices(texts) for t in some.to_pylist()]
        spans = [[{"start": a, "end": b, "p": p} for a, b, p in s] for _, s in found]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array(spans, kind)], names=["score", "spans"])

    return judge(text)


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 from 0.5 on), spans (start, end in code points, marginal).

    Rows come out as they came in, repeated ones too; a NULL or empty text has the score of
    a text without cues and no spans. Other columns are not read.
    """
    return docs.select(F.col(id_col), judged(F.col(text_col), field).alias("found")).select(
        id_col, "found.score", F.when(F.col("found.score") >= 0.5, 1).otherwise(0).alias("predicted"), "found.spans")


def drop_toxic(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a score under 0.5, all columns as they were; NULL and empty texts stay."""
    return docs.where(judged(F.col(text_col), field)["score"] < 0.5)


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """Whether a row is kept from learning: by the remainder of its id's checksum. Rows without an id are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def rows_to_learn(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.where(~held_out(F.col(id_col)))
