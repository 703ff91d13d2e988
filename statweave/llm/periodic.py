"""Periodic runs of words in whole texts, exactly, by multi-scale minimizers.

A run of period q repeats each of its windows q words later, so the least hash of a window
comes again at distance q. At scale g (a power of two) windows of g blocks of g words are
looked at; equal minima between 2g and 4g apart seed the periods in that range. Periods
under 8 are found by comparing the sequence with itself at that lag.

A block that is itself periodic (period up to g/2) comes densely. Its occurrences fill a run
that a smaller scale has found, and two occurrences inside one such run show no new period.
Of those in different runs only the first ones, the last ones, or, where the runs touch, the
distances in step with both can start a new run. So the number of seeds stays in proportion
to the words and to the runs found, however repetitive the text is.

Seeds are extended in both directions by comparing blocks of halving length. Blocks are
named by 64-bit hashes of exact word numbers. Texts of a slab lie one after another in one
array, with numbers between them that occur once, so no run leaves its text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

SHORT = 8  # periods below it are compared directly
LEAST = 12  # words of a run, at least
SLAB = 300_000  # words worked on together, unless one text alone has more
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """What lies between blanks and the control characters 9 to 13."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class Blocks:
    """Hashes of all blocks of 1, 2, 4, ... words of a sequence of numbers; level k holds those of 2**k words."""

    def __init__(self, words: np.ndarray, longest: int):
        self.n = len(words)
        self.levels = [mix(words.astype(np.uint64) + np.uint64(1))]
        while 2 << (len(self.levels) - 1) <= longest:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(mix(last[:len(last) - half] * _STEP + (last[half:] ^ (last[half:] >> np.uint64(31)))))

    def extend(self, left: np.ndarray, right: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from left and right on, or, with `back`, before them."""
        length = np.zeros(len(left), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, size = self.levels[k], 1 << k
            while True:  # the highest level may fit more than once
                a, b = (left - length - size, right - length - size) if back else (left + length, right + length)
                fits = np.flatnonzero((np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(level)))
                fits = fits[level[a[fits]] == level[b[fits]]]
                length[fits] += size
                if k < len(self.levels) - 1 or not len(fits):
                    break
        return length


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the leftmost least value of some `width` (a power of two) values in a row."""
    place, least, size = np.arange(len(values)), values, 1
    while size < width:
        right = least[size:] < least[:-size]
        place = np.where(right, place[size:], place[:-size])
        least = np.where(right, least[size:], least[:-size])
        size *= 2
    return place[np.r_[True, place[1:] != place[:-1]]] if len(place) else place


def _equal_pairs(names: np.ndarray, places: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs of equal names whose places are `low` to `high` - 1 apart, left one first."""
    order = np.lexsort((places, names))
    name, place, firsts, seconds, step = names[order], places[order], [], [], 1
    live = np.arange(len(order))
    while True:
        live = live[live + step < len(order)]
        live = live[(name[live] == name[live + step]) & (place[live + step] - place[live] < high)]
        if not len(live):
            return (np.concatenate(firsts), np.concatenate(seconds)) if firsts else (np.zeros(0, np.int64),) * 2
        far = live[place[live + step] - place[live] >= low]
        firsts.append(order[far])
        seconds.append(order[far + step])
        step += 1


class Runs:
    """Runs found so far: start, end, least period; one row for each stretch."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Keep stretches of at least two periods; a stretch found with several has the least of them."""
        whole = end - start >= 2 * period
        start, end, period = (np.concatenate([old, new[whole]]) for old, new in
                              ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
        self.start, self.end, self.period = start[first], end[first], period[first]

    def around(self, places: np.ndarray, size: int) -> tuple[np.ndarray, Runs]:
        """For blocks of `size` words the run of period size / 2 at most that holds them, or -1; and these runs."""
        some = Runs()
        fit = (self.period <= size // 2) & (self.end - self.start >= size)
        some.start, some.end, some.period = self.start[fit], self.end[fit], self.period[fit]
        if not len(some.start):
            return np.full(len(places), -1), some
        at = np.searchsorted(some.start, places, "right") - 1  # two such runs overlap by less than a block
        inside = (at >= 0) & (places + size <= some.end[at])
        return np.where(inside, at, -1), some


def _seeds(names: np.ndarray, g: int, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) from which every run with a period in [2g, 4g) can be grown."""
    places = _minima(names, g)
    held, known = runs.around(places, g)
    free = places[held < 0]
    a, b = _equal_pairs(names[free], free, 2 * g, 4 * g)
    left, lag = [free[a]], [free[b] - free[a]]
    inside, at = places[held >= 0], held[held >= 0]
    if len(inside):
        start, end, period = known.start[at], known.end[at], known.period[at]
        first = start + (inside - start) % period
        _, one = np.unique(np.stack([at, first]), axis=1, return_index=True)
        inside, start, end, period, first, at = (x[one] for x in (inside, start, end, period, first, at))
        last = first + (end - g - first) // period * period
        name = names[first]
        for ends in (first, last):
            a, b = _equal_pairs(name, ends, 2 * g, 4 * g)
            left.append(ends[a])
            lag.append(ends[b] - ends[a])
        order = np.lexsort((start, name))  # runs that touch are neighbours among those with this block
        a, b = order[:-1], order[1:]
        touch = (name[a] == name[b]) & (at[a] != at[b]) & (start[b] <= end[a])
        a, b = a[touch], b[touch]
        most = np.minimum(4 * g - 1, np.minimum(end[a] - start[a], end[b] - start[b]))
        lowest = 2 * g + (first[b] - first[a] - 2 * g) % period[a]
        count = np.maximum(0, (most - lowest) // period[a] + 1)
        pair = np.repeat(np.arange(len(a)), count)
        turn = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        q = lowest[pair] + turn * period[a][pair]
        # The last place of the left run whose partner lies in the right one.
        left.append(np.maximum(start[a][pair], start[b][pair] - q))
        lag.append(q)
    return np.concatenate(left), np.concatenate(lag)


def _direct(words: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all stretches in which words `lag` apart agree."""
    same = np.zeros(max(0, len(words) - lag) + 2, np.int8)
    same[1:-1] = words[lag:] == words[:-lag] if len(words) > lag else 0
    turns = np.diff(same)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1) + lag


def all_runs(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run of two periods or more, of whatever length, in the order of start, end."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.cumsum(sizes + 1) - sizes - 1
    runs = Runs()
    if not sizes.sum():
        return (np.zeros(0, np.int64),) * 4
    words = np.full(int(sizes.sum() + len(sizes)), -1, np.int64)
    for at, text in zip(offset.tolist(), texts):
        words[at:at + len(text)] = text
    gaps = offset + sizes
    words[gaps] = max(int(words.max()), 0) + 1 + np.arange(len(gaps))
    for lag in range(1, SHORT):
        start, end = _direct(words, lag)
        runs.add(start, end, np.full(len(start), lag))
    g = SHORT // 2
    longest = int(sizes.max())
    if longest >= 4 * g:
        blocks = Blocks(words, longest // 2)
        while 4 * g <= longest:
            left, lag = _seeds(blocks.levels[g.bit_length() - 1], g, runs)
            lag, left = np.unique(np.stack([lag, left]), axis=1)
            start = left - blocks.extend(left, left + lag, back=True)
            end = left + lag + blocks.extend(left, left + lag, back=False)
            runs.add(start, end, lag)
            g *= 2
    text = np.searchsorted(offset, runs.start, "right") - 1
    return text, runs.start - offset[text], runs.end - runs.start, runs.period


def rewritten(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One text in ten, by its id's checksum, goes on periodically from some word; without an id none does."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _columns(texts: list[list[bytes]]) -> list[pa.Array]:
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, kept words of texts."""
    number: dict[bytes, int] = {}
    coded = [np.fromiter((number.setdefault(w, len(number)) for w in t), np.int64, len(t)) for t in texts]
    text, start, length, period = all_runs(coded)
    fit = length >= LEAST  # two periods they all have
    text, start, length, period = text[fit], start[fit], length[fit], period[fit]
    order = np.lexsort((period, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    edges = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    rows = []
    for words, a, b in zip(texts, edges, edges[1:]):
        s, n, q = start[a:b], length[a:b], period[a:b]
        told = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), n.tolist(), q.tolist()))
        kept, best = words, (None,) * 4
        if a < b:
            turns = np.zeros(len(words) + 1, np.int64)
            np.add.at(turns, s + q, 1)
            np.add.at(turns, s + n, -1)
            kept = [words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0).tolist()]
            top = int(np.lexsort((q, s, -n))[0])
            best = (int(s[top]), int(n[top]), int(q[top]), 1000 * int(n[top]) // int(q[top]))
        rows.append((b - a, *best, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), len(kept)))
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
    return [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False) -> DataFrame:
    """Per row: id, n_runs, start, length, period and exponent_milli of the longest run, runs_sha256, collapsed_sha256, n_kept.

    A run is a longest stretch of at least 12 words and two periods in which words one period
    apart are equal. Ties of the longest go to the smaller start. What a run repeats after its
    first period is left out of the collapsed text. NULL counts as the empty text, which has
    no runs. Rows come out as they came in, repeated ones too; other columns are not read.
    `rewrite` first makes one text in ten periodic by its id's checksum, for which the id must
    be a whole number; rows without an id stay as they are.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, size = 0, [], 0
            ids = batch.column("id").to_pylist()
            for k, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                held.append(rewritten(words, ids[k]) if rewrite else words)
                size += len(words)
                if size >= SLAB or k + 1 == len(ids):
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(held)), *_columns(held)], names=names)
                    at, held, size = k + 1, [], 0

    names = ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_kept"]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, n_kept bigint"
    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_col)
