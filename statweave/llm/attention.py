"""Scores of whole texts by a causal self-attention model over subword ids, and by word counts.

Words are what lies between blanks, in lower case; each is coded by a public byte-level
tokenizer, with a blank before it, and a text ends with an end id. The model gives each id

    p(id | before) = p(class of id | before) * p(id | class).

The class is predicted by one layer of causal attention over the ids before it, written in
numpy. p(id | class) and the word counts come from all texts that may be learned from: words are counted by
Spark, and the ids of each different word are weighted with its count.

The attention weights are learned in two steps. A first fit on the driver, from a bounded
number of windows, only gives the weights from which the second step sets out. That step goes
over every id of every text that may be learned from: each task cuts its whole texts into
windows, gathers them in shards of bounded size, and each shard goes on from the first weights
for one pass; the weights of all shards are averaged, by their windows, level by level. What is
learned so grows with the corpus, and nothing but weights is moved.

A text longer than a window is scored in windows that overlap: each window after the first
scores only its last ids and has the others as context, so each id is scored once. Windows
of many texts are scored together under one causal mask.

Word counts of the most frequent words are known to every task; the other words of a text
are looked up by a join, so no table of all words is ever broadcast.
"""

from __future__ import annotations

import base64
import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_group, slices, written

WIDTH, CONTEXT = 32, 8  # ids in a window; ids of a later window that are context only
DIMS, ROWS, OWN, GROUPS = 16, 4096, 48, 48  # vector size, ids with a vector of their own, classes of one id, other classes
SAMPLE, STEPS, PASSES = 8192, 768, 12  # windows of the first fit; steps to take, but no more passes than so many
SHARD = 16_384  # windows of a shard of the second step, at most
TEXTS = 250  # texts coded at once
AVERAGED = 64  # sets of weights added up in one task
HOT = 200_000  # words whose counts every task knows, at most
LONGEST = 64  # bytes of such a word
CACHED = 400_000  # words a worker remembers
RATE, LATER_RATE, BATCH = 0.03, 0.005, 64
LOT = 2000  # words coded as one text
_OTHER = re.compile(r"[^\S \n]")  # white space besides blank and line break
_NEWLINE = 198  # fixed value: the id of a line break in this vocabulary


# --- subword ids ------------------------------------------------------------------


class Subwords:
    """Ids of words, a blank before each, by a file of ranks; the id after the last one is the end of a text."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.coder = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.end = max(self.ranks.values()) + 1
        self.cuts = self.coder.encode_ordinary("\n") == [_NEWLINE]

    def coded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has.

        A lot of plain words is coded as one text and cut at the line breaks between them;
        lots in which a word has some other white space are coded word by word.
        """
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), LOT):
            some = words[at:at + LOT]
            text = (b" " + b"\n ".join(some) + b"\n").decode("utf-8", "surrogatepass")
            if self.cuts and all(some) and not _OTHER.search(text):
                ids = np.array(self.coder.encode_ordinary(text), np.int32)
                ends = ids == _NEWLINE
                flat.append(ids[~ends])
                sizes.append(np.diff(np.flatnonzero(ends), prepend=-1) - 1)
            else:
                each = [self.coder.encode_ordinary(" " + w.decode("utf-8", "surrogatepass")) for w in some]
                flat.append(np.array([i for ids in each for i in ids], np.int32))
                sizes.append(np.array([len(ids) for ids in each], np.int64))
        return np.concatenate(flat), np.concatenate(sizes)

    def of(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        flat, sizes = self.coded(words)
        return np.split(flat, np.cumsum(sizes)[:-1]) if words else []


_subwords: dict[tuple[str, str], Subwords] = {}


def subwords(path: str, pattern: str) -> Subwords:
    if (path, pattern) not in _subwords:
        _subwords[path, pattern] = Subwords(path, pattern)
    return _subwords[path, pattern]


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks and control characters 9 to 13, A to Z as a to z."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# --- the model --------------------------------------------------------------------


def _powers(make: Callable[[], np.ndarray], seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Powers of what `make` gives, 0 where `seen` is 0, and their sums over the last axis: shares that are not divided yet."""
    out = make()
    np.exp(out, out=out)
    if seen is not None:
        out *= seen
    total = (out.reshape(-1, out.shape[-1]) @ np.ones(out.shape[-1], np.float32)).reshape(*out.shape[:-1], 1)
    if not ((total > 1e-30) & (total < 1e30)).all():  # numbers too large or too small for plain powers and products with them
        out = make()
        if seen is not None:
            out = np.where(seen > 0, out, np.float32(-np.inf))
        out = np.exp(out - out.max(axis=-1, keepdims=True))
        total = out.sum(axis=-1, keepdims=True)
    return out, total


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def _by(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w as one product over all places, not one for each window."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], -1)


class Attention:
    """One layer: vectors of ids and places, causal attention, classes. Weights in one flat array."""

    def __init__(self, rows: int, classes: int, width: int, dims: int, weights: np.ndarray | None = None):
        self.shapes = {"E": (rows, dims), "P": (width, dims), "Q": (dims, dims), "K": (dims, dims), "V": (dims, dims),
                       "O": (dims, dims), "U": (dims, classes), "c": (classes,)}
        self.width, self.dims = width, dims
        self.size = sum(map(math.prod, self.shapes.values()))
        if weights is None:
            weights = np.random.default_rng(7).normal(0, 0.1, self.size).astype(np.float32)
        self.weights = weights.astype(np.float32)
        self.parts = self._named(self.weights)
        self.seen = np.tri(width, dtype=np.float32)

    def _named(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of a flat array, by name; they share its memory."""
        out, at = {}, 0
        for name, shape in self.shapes.items():
            out[name] = flat[at:at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
        return out

    def hidden(self, inputs: np.ndarray, first: int = 0) -> np.ndarray:
        """Vectors after attention, for the places of each window from `first` on."""
        w = self.parts
        x = w["E"][inputs] + w["P"]
        own = x[:, first:]
        q, k, v = _by(own, w["Q"]), _by(x, w["K"]), _by(x, w["V"])
        a, total = _powers(lambda: (q * np.float32(self.dims**-0.5)) @ k.transpose(0, 2, 1), self.seen[first:])
        return own + _by(a @ v / total, w["O"])

    def chances(self, inputs: np.ndarray, first: int = 0) -> np.ndarray:
        """Class distribution at each place from `first` on."""
        h = self.hidden(inputs, first)
        p, total = _powers(lambda: _by(h, self.parts["U"]) + self.parts["c"])
        return p / total

    def folded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights multiplied out for scoring: query by key, vectors and values to classes, powers of the classes' own weights."""
        w = self.parts
        keys = w["Q"] @ w["K"].T * np.float32(self.dims**-0.5)
        return keys, np.concatenate([w["U"], w["V"] @ w["O"] @ w["U"]]), np.exp(w["c"])

    def log_chances(self, folded: tuple[np.ndarray, ...], inputs: np.ndarray, targets: np.ndarray, first: int = 0) -> np.ndarray:
        """log of the target classes' chances at each place from `first` on: the same as `chances`, with fewer passes."""
        keys, classes, powers = folded
        x = self.parts["E"].take(inputs, axis=0)
        x += self.parts["P"]
        a = _by(x, keys)[:, first:] @ x.transpose(0, 2, 1)
        np.exp(a, out=a)
        a *= self.seen[first:]
        o = _flat(a @ x)
        o /= (_flat(a) @ np.ones(self.width, np.float32))[:, None]
        z = np.concatenate([x[:, first:].reshape(o.shape), o], axis=1) @ classes
        t = targets.ravel()
        out = z[np.arange(len(z)), t] + self.parts["c"][t]
        np.exp(z, out=z)
        out -= np.log(z @ powers)
        if not np.isfinite(out).all():  # numbers too large for plain powers
            p = self.chances(inputs, first).reshape(len(z), -1)
            out = np.log(p[np.arange(len(z)), t] + np.float32(1e-30))
        return out.reshape(targets.shape)

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean negative log likelihood of the target classes at real places, and its gradient.

        Shares are never divided out: their sums go into the few numbers of a place that they are multiplied with.
        """
        w, d, n, scale = self.parts, self.dims, max(1, int(real.sum())), np.float32(self.dims**-0.5)
        grad = np.zeros(self.size, np.float32)
        g = self._named(grad)
        into = np.concatenate([w["Q"] * scale, w["K"], w["V"]], axis=1)
        x = w["E"].take(inputs, axis=0)
        x += w["P"]
        qkv = _by(x, into)
        q, k, v = qkv[..., :d], qkv[..., d:2 * d], qkv[..., 2 * d:]
        a, total = _powers(lambda: q @ k.transpose(0, 2, 1), self.seen)
        o = a @ v
        o /= total
        h = np.ones((targets.size, d + 1), np.float32)
        np.add(_flat(x), _flat(o) @ w["O"], out=h[:, :d])
        ends = np.concatenate([w["U"], w["c"][None]])
        p, sums = _powers(lambda: h @ ends)
        hit, sums, counts = (np.arange(len(p)), targets.ravel()), sums.ravel(), real.ravel().astype(np.float32)
        found = p[hit]
        p[hit] = found - sums
        loss = -float(np.log(found / sums + np.float32(1e-30)) @ counts) / n
        share = (counts / (sums * np.float32(n)))[:, None]
        dh = p @ w["U"].T
        dh *= share
        h *= share
        do = (dh @ w["O"].T).reshape(o.shape)
        do /= total
        ds = do @ v.transpose(0, 2, 1)
        ds -= (_flat(do * o) @ np.ones(d, np.float32)).reshape(total.shape)  # the same as the sum of a by its gradient
        ds *= a
        dqkv = np.empty_like(qkv)
        np.matmul(ds, k, out=dqkv[..., :d])
        np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[..., d:2 * d])
        np.matmul(a.transpose(0, 2, 1), do, out=dqkv[..., 2 * d:])
        mid = _flat(x).T @ _flat(dqkv)
        g["Q"][:], g["K"][:], g["V"][:] = mid[:, :d] * scale, mid[:, d:2 * d], mid[:, 2 * d:]
        g["O"][:], g["U"][:], g["c"][:] = _flat(o).T @ dh, h[:, :d].T @ p, h[:, d] @ p
        dx = dh + _flat(dqkv) @ into.T
        g["P"][:] = dx.reshape(len(inputs), self.width, d).sum(axis=0)
        two = np.complex64 if d % 2 == 0 else np.float32  # adds two numbers at a time
        lanes = np.arange(dx.view(two).shape[1])
        np.add.at(g["E"].view(two).reshape(-1), (inputs.reshape(-1, 1) * len(lanes) + lanes).ravel(), dx.view(two).ravel())
        return loss, grad

    def fit(self, windows: np.ndarray, rows: np.ndarray, classes: np.ndarray, epochs: int, rate: float, batch: int = BATCH) -> list[float]:
        """Go over windows (the id before, then ids; -1 after the end) by gradient steps of adapted size; losses of the passes."""
        inputs, targets = (x.astype(np.int64) for x in (rows[np.maximum(windows[:, :-1], 0)], classes[np.maximum(windows[:, 1:], 0)]))
        real = windows[:, 1:] >= 0
        slow, fast, step, losses, turn = *(np.zeros_like(self.weights) for _ in range(3)), [], 0  # sums of fading gradients and of their squares
        turns = max(1, epochs * -(-len(windows) // batch))
        for epoch in range(epochs):
            order, total = np.random.default_rng(epoch).permutation(len(windows)), 0.0
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                loss, grad = self.gradient(inputs[some], targets[some], real[some])
                turn += 1
                slow *= np.float32(0.9)
                slow += grad
                grad *= grad
                fast *= np.float32(0.98)
                fast += grad
                spread = (0.02 / (1 - 0.98**turn)) ** 0.5
                np.sqrt(fast, out=step)
                step += np.float32(1e-8 / spread)
                np.divide(slow, step, out=step)
                step *= np.float32(rate * min(1.0, 2 * (1 - turn / turns) + 0.05) * 0.1 / (1 - 0.9**turn) / spread)
                self.weights -= step
                total += loss * len(some)
            losses.append(total / max(1, len(order)))
        return losses


@dataclass
class Model:
    """What was learned: counts of all words, and the model over ids."""

    counts: DataFrame  # word, n_all, n_train; a table in the shared folder
    tokens: int  # training tokens, ends counted
    distinct: int
    ends: int
    hot: dict[bytes, int]  # training counts of the most frequent words
    coder: tuple[str, str]  # path and pattern of the subwords
    rows: np.ndarray  # id -> row of its vector
    classes: np.ndarray  # id -> class
    inside: np.ndarray  # id -> log p(id | class)
    weights: np.ndarray
    width: int = WIDTH
    context: int = CONTEXT
    losses: list[float] = field(default_factory=list)
    key: str = field(default_factory=lambda: uuid.uuid4().hex)  # tells models apart in workers

    def lean(self) -> Model:
        """Without what tasks do not need."""
        return replace(self, counts=None, losses=[])

    def attention(self) -> Attention:
        return Attention(int(self.rows.max()) + 1, int(self.classes.max()) + 1, self.width, DIMS, self.weights)

    def log_p(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def score_ids(model: Attention, ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray, classes: np.ndarray, inside: np.ndarray,
              end: int, context: int, batch: int = 64) -> np.ndarray:
    """log10 probability of each text; `ids` holds the ids of all texts, `sizes` how many each has (at least one)."""
    width, begin = model.width, np.cumsum(sizes) - sizes
    step = width - context
    later = np.maximum(0, -(-(sizes - width) // step))
    own = rows[ids]
    before = np.r_[rows[end], own[:-1]]
    before[begin] = rows[end]
    # Places behind a text's end hold what comes next; no place before them sees it, and they are not counted.
    stretch = lambda x: np.lib.stride_tricks.sliding_window_view(np.r_[x, np.zeros(width, x.dtype)], width)
    before, kind, folded = stretch(before.astype(np.int64)), stretch(classes[ids]), model.folded()
    total = np.add.reduceat(inside[ids].astype(np.float64), begin)
    for first, text, start in (
        (0, np.arange(len(sizes)), np.zeros(len(sizes), np.int64)),
        (context, np.repeat(np.arange(len(sizes)), later), (np.arange(int(later.sum())) - np.repeat(np.cumsum(later) - later, later) + 1) * step),
    ):
        for at in range(0, len(text), batch):
            t, s = text[at:at + batch], start[at:at + batch]
            place = begin[t] + s
            found = model.log_chances(folded, before[place], kind[place, first:], first)
            found *= np.arange(first, width) < (sizes[t] - s)[:, None]
            total += np.bincount(t, found.sum(axis=1, dtype=np.float64), len(sizes))
    return total / np.log(10)


# --- learning ---------------------------------------------------------------------


def word_counts(docs: DataFrame, learns: Column, text_col: str = "text") -> DataFrame:
    """(word, n_all, n_train) over whole texts; the empty word counts the texts' ends."""
    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (Counter(), Counter())
            for text, learn in zip(batch.column("text"), batch.column("learns").to_pylist()):
                both[learn].update(words_of(text.as_py()))
                both[learn][b""] += 1
            for some, train in zip(both, (False, True)):
                if some:
                    n = pa.array(list(some.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(list(some), pa.binary()), n, n if train else pa.array(np.zeros(len(some), np.int64))],
                                                     names=["word", "n_all", "n_train"])

    return rows.mapInArrow(count, "word binary, n_all bigint, n_train bigint").groupBy("word").agg(
        F.sum("n_all").alias("n_all"), F.sum("n_train").alias("n_train"))


def id_counts(counts: DataFrame, coder: tuple[str, str]) -> DataFrame:
    """(id, n): ids of all words, each word as often as it was counted for training."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = subwords(*coder)
        for batch in batches:
            for some in slices(batch, 20_000):
                (flat, sizes), n = source.coded(some.column("word").to_pylist()), some.column("n_train").to_numpy()
                kinds, back = np.unique(flat, return_inverse=True)
                total = np.zeros(len(kinds), np.int64)
                np.add.at(total, back, np.repeat(n, sizes))
                yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), pa.array(total)], names=["id", "n"])

    known = counts.where((F.col("n_train") > 0) & (F.length("word") > 0)).select("word", "n_train")
    return known.mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def tables(counts: dict[int, int], source: Subwords, ends: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per id: row of its vector, class, log p(id | class). Frequent ids stand alone, the others are grouped by their letters."""
    size = source.end + 1
    n = np.zeros(size)
    n[list(counts)] = list(counts.values())
    n[source.end] = ends
    often = np.argsort(-n, kind="stable")
    rows, classes = np.zeros(size, np.int32), np.zeros(size, np.int32)
    single = np.unique(np.r_[source.end, often[:OWN - 1]])
    classes[single] = np.arange(len(single))
    rest = np.ones(size, bool)
    rest[single] = False
    names = {rank: word for word, rank in source.ranks.items()}
    order = np.array([i for i in sorted(names, key=lambda i: (not names[i].startswith(b" "), names[i])) if rest[i]], np.int64)
    mass = np.cumsum(n[order] + 0.5)
    group = np.minimum((mass / mass[-1] * GROUPS).astype(np.int64), GROUPS - 1)
    classes[order] = len(single) + group
    rest[order] = False
    classes[rest] = classes[order[-1]]  # ids that no rank uses
    whole = np.bincount(classes, n + 0.5)
    _, classes = np.unique(classes, return_inverse=True)
    own = np.unique(np.r_[source.end, often[:ROWS - 1]])
    rows[:] = classes
    rows[own] = int(classes.max()) + 1 + np.arange(len(own))
    return rows, classes.astype(np.int32), np.log((n + 0.5) / whole[whole > 0][classes]).astype(np.float32)


def first_windows(docs: DataFrame, learns: Column, coder: tuple[str, str], width: int, most: int, total: int, text_col: str = "text") -> DataFrame:
    """(ids): one window each of about `most` of the `total` texts to learn from, at a place that the checksum picks; the id before first.

    Rows are numbered, so that of many copies of one text no more than their share are drawn.
    """
    rows = docs.where(learns).select(F.coalesce(text_col, F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    drawn = rows.withColumn("h", F.xxhash64("text")).where(F.pmod(F.xxhash64("row", "h"), F.lit(total)) < most).select("text", "h")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = subwords(*coder)
        for batch in batches:
            for some in slices(batch):
                out = []
                for text, h in zip(some.column("text"), some.column("h").to_pylist()):
                    words = words_of(text.as_py())
                    at = h % (len(words) + 1) if h % 4 else 0  # one in four begins with the text
                    own = source.of(words[max(0, at - 1):at + width]) + [np.array([source.end])] * (at + width > len(words))
                    own = np.concatenate([np.array([source.end]), *own] if at == 0 else [own[0][-1:], *own[1:]])[:width + 1]
                    out.append(np.r_[own, np.full(width + 1 - len(own), -1)].astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    return drawn.mapInArrow(cut, "ids binary")


def _matrix(ids: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(ids), np.int32).reshape(-1, width + 1)


def windows_of(ids: np.ndarray, sizes: np.ndarray, width: int, end: int) -> np.ndarray:
    """All ids of texts in windows, each id in one: the id before first, -1 after the end. `sizes`: ids of each text, its end included."""
    begin, each = np.cumsum(sizes) - sizes, -(-sizes // width)
    text = np.repeat(np.arange(len(sizes)), each)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)) * width
    place = start[:, None] + np.arange(-1, width)
    found = ids[np.clip(begin[text][:, None] + place, 0, len(ids) - 1)]
    found[place < 0] = end
    found[place >= sizes[text][:, None]] = -1
    return found.astype(np.int32)


def averaged(docs: DataFrame, learns: Column, model: Model, text_col: str = "text") -> np.ndarray:
    """Weights after one more pass over all ids: every shard of windows goes on from the model's weights, and the shards' results are averaged."""
    shared = docs.sparkSession.sparkContext.broadcast(model.lean())
    rows = docs.where(learns).select(F.col(text_col).alias("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: Model = shared.value
        met, held, sums, total = _met(given), np.zeros((0, given.width + 1), np.int32), np.zeros(len(given.weights)), 0

        def passed(windows: np.ndarray) -> np.ndarray:
            own = given.attention()
            own.fit(windows, given.rows, given.classes, 1, LATER_RATE)
            return own.weights.astype(np.float64) * len(windows)

        for batch in batches:
            for some in slices(batch, TEXTS):
                _, sizes, numbers, begin = met.texts(some.column("text").to_pylist())
                lengths = np.add.reduceat(met.size[numbers], begin)
                held = np.concatenate([held, windows_of(met.ids(numbers), lengths, given.width, met.source.end)])
                while len(held) >= SHARD:
                    sums += passed(held[:SHARD])
                    total, held = total + SHARD, held[SHARD:]
        if len(held):
            sums += passed(held)
            total += len(held)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(total)]),
                                              pa.array([sums.astype(np.float32).tobytes()], pa.binary())], names=["part", "n", "sums"])

    def add(group: pa.Table) -> pa.RecordBatch:
        sums = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in group.column("sums"))
        return pa.RecordBatch.from_arrays([group.column("part").combine_chunks()[:1], pa.array([sum(group.column("n").to_pylist())]),
                                           pa.array([sums.astype(np.float32).tobytes()], pa.binary())], names=["part", "n", "sums"])

    schema = "part bigint, n double, sums binary"
    found = written(rows.mapInArrow(learn, schema), "weights")
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while parts > AVERAGED:
        parts = -(-parts // AVERAGED)
        found = written(per_group(found.withColumn("part", F.expr(f"part DIV {AVERAGED}")).repartition(parts, "part").sortWithinPartitions("part", "n", "sums"),
                                  ["part"], add, schema, dealt=True), "weights")
    rows = sorted(found.collect(), key=lambda r: r.part)  # at most AVERAGED sets of weights
    if not rows:
        return model.weights
    return (sum(np.frombuffer(r.sums, np.float32).astype(np.float64) for r in rows) / sum(r.n for r in rows)).astype(np.float32)


def _frequent(counts: DataFrame, most: int) -> list:
    """The words whose count is above a bound that no more than `most` words pass.

    The bound comes from the numbers of words with counts of about the same size, so that no
    task hands the driver a list of its own.
    """
    size = F.floor(F.log2(F.col("n_all")) * 16)
    bound = None
    total = 0
    for r in sorted(counts.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):  # 16 sizes for each doubling
        total += r["count"]
        if total > most:
            break
        bound = r["size"]
    return counts.where(size >= bound).select("word", "n_train").collect() if bound is not None else []


def train(docs: DataFrame, learns: Column, tokenizer: str, pattern: str, text_col: str = "text", sample: int = SAMPLE, hot: int = HOT) -> Model:
    """Learn from the texts for which `learns` is true; NULL counts as false, a NULL text as empty.

    About `sample` windows, drawn by checksums, are brought to the driver for the first fit; all
    ids of all texts take part in the second. At most `hot` words of at most 64
    bytes, the most frequent of all texts, are brought to the driver with their counts. Without
    any text to learn from the model has its first, random weights.
    """
    coder = (tokenizer, pattern)
    counts = written(word_counts(docs, learns, text_col), "words")
    told = counts.agg(F.sum("n_train").alias("tokens"), F.count_if(F.col("n_train") > 0).alias("distinct"),
                      F.max(F.when(F.length("word") == 0, F.col("n_train"))).alias("ends")).first()
    often = _frequent(counts.where(F.length("word") <= LONGEST), hot)
    ids = {r.id: r.n for r in id_counts(counts, coder).collect()}  # no more than the vocabulary
    rows, classes, inside = tables(ids, subwords(*coder), told.ends or 0)
    model = Model(counts, told.tokens or 0, told.distinct or 0, told.ends or 0, {bytes(r.word): r.n_train for r in often},
                  coder, rows, classes, inside, np.zeros(0))
    model.hot[b""] = model.ends
    first = Attention(int(rows.max()) + 1, int(classes.max()) + 1, model.width, DIMS)
    learns = F.coalesce(learns, F.lit(False))
    drawn = first_windows(docs, learns, coder, model.width, sample, max(1, model.ends), text_col)
    few = [r.ids for r in drawn.collect()]
    few.sort()
    if few:
        model.losses = first.fit(_matrix(few, model.width), rows, classes, min(PASSES, -(-STEPS * BATCH // len(few))), RATE)
    model.weights = first.weights
    model.weights = averaged(docs, learns, model, text_col)
    return model


# --- scoring ----------------------------------------------------------------------


class Words:
    """Words that a worker has met: their ids and, of frequent words, their counts."""

    def __init__(self, source: Subwords, hot: dict[bytes, int]):
        self.source, self.hot = source, hot
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = defaultdict(count(1).__next__, {b"": 0})  # 0: the end of a text; a new word gets the next number
        self.flat = np.array([self.source.end], np.int32)
        self.begin, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.count = np.array([self.hot[b""]], np.int64)  # -1: not among the frequent ones

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > CACHED:
            self.clear()
        known = len(self.size)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if len(self.number) > known:
            new = list(islice(reversed(self.number), len(self.number) - known))[::-1]
            ids, size = self.source.coded(new)
            self.begin = np.r_[self.begin, len(self.flat) + np.cumsum(size) - size]
            self.size, self.flat = np.r_[self.size, size], np.concatenate([self.flat, ids])
            self.count = np.r_[self.count, [self.hot.get(w, -1) for w in new]]
        return numbers

    def texts(self, texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Words of all texts, an empty one behind each text; how many each text has; their numbers; where each text begins."""
        flat, ends = [], []
        for text in texts:
            flat += words_of(text)
            flat.append(b"")
            ends.append(len(flat))
        sizes = np.diff(np.array(ends, np.int64), prepend=0)
        return flat, sizes, self.numbers(flat), np.cumsum(sizes) - sizes

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        size = self.size[numbers]
        return self.flat[np.repeat(self.begin[numbers] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


_words: dict[str, Words] = {}


def _met(model: Model) -> Words:
    if model.key not in _words:
        _words.clear()  # of another model
        _words[model.key] = Words(subwords(*model.coder), model.hot)
    return _words[model.key]


def _scorer(shared: Broadcast) -> Callable[[list[str | None]], list[pa.Array]]:
    """Scores of a list of texts: tokens, known ones, base score, score, words to look up, subword ids."""
    model: Model = shared.value
    met, own = _met(model), model.attention()

    def score(texts: list[str | None]) -> list[pa.Array]:
        flat, sizes, numbers, begin = met.texts(texts)
        count = met.count[numbers]
        base = np.where(count < 0, 0.0, model.log_p(np.maximum(count, 0)))
        cold = np.flatnonzero(count < 0)
        cuts = np.r_[np.searchsorted(cold, begin), len(cold)].astype(np.int32)
        lengths = np.add.reduceat(met.size[numbers], begin)
        total = score_ids(own, met.ids(numbers), lengths, model.rows, model.classes, model.inside, met.source.end, model.context)
        return [pa.array(sizes), pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)), pa.array(np.add.reduceat(base, begin)), pa.array(total),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array([flat[k] for k in cold.tolist()], pa.binary())), pa.array(lengths)]

    return score


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score, n_subwords.

    Tokens are the words and one end; known ones were counted in training. base_score adds up
    log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens, score is the model's log10
    probability of the text's ids, end included. NULL counts as the empty text, which has only its end. Rows come
    out as they came in, repeated ones too; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.lean())  # HOT words of LONGEST bytes at most, and tables of the vocabulary's size
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    names = ["id", "part", "row", "n_tokens", "n_known", "base", "score", "words", "n_subwords"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, row = _scorer(shared), 0
        for batch in batches:
            for some in slices(batch, TEXTS):
                number = pa.array(np.arange(row, row + len(some)))
                row += len(some)
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("part"), number, *score(some.column("text").to_pylist())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    found = written(rows.mapInArrow(work, f"id {kind}, part int, row bigint, n_tokens bigint, n_known bigint, base double, score double, words array<binary>, n_subwords bigint"), "scored")
    # Words that are not among the frequent ones: their counts come by a join, whatever their number. (part, row) is unique in the written table.
    rare = found.select("part", "row", F.explode("words").alias("word"))
    known = model.counts.where("n_train > 0").select("word", "n_train")
    scale = float(model.tokens + 0.5 * (model.distinct + 1))
    c = F.coalesce("n_train", F.lit(0))
    more = rare.join(known, "word", "left").groupBy("part", "row").agg(
        F.sum(F.log10((c + 0.5) / F.lit(scale))).alias("more"), F.count_if(c > 0).alias("more_known"))
    both = found.drop("words").join(more, ["part", "row"], "left")
    return both.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", "n_subwords")
