"""Language of a text by cross-parsing: the language whose labelled text says it in the fewest phrases.

For each language a suffix automaton of a bounded sample of labelled text is built. A text
is cut greedily into the longest phrases that occur in that sample, by walking the
automaton until it has no step on. A phrase costs as many bits as naming a place in the
sample, so phrases times log2(sample length) is the cost of the text, and samples of
different sizes compare fairly.

Texts advance together: they are cut into stretches of equal length, and one step of all
stretches is an index into a table of transitions. The table has a column for each of the
most used letters; steps by any other learned letter are searched among sorted keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_group, slices

LEARN = 40_000  # letters and blanks learned per language, to the end of the document that reaches it
SAMPLE = 300  # documents per language that may be learned from
SYMBOLS = 200  # most used letters, which have a column in the tables; the others' steps are sorted keys
STRETCH = 256
AT_ONCE = 1 << 22  # letters that are parsed together
SOFT = 8.0  # bits of difference that halve a language's weight in the score
NONE = "und"
_STOP = np.int32(1 << 30)  # marks a step that ends a phrase
_BLANK = 32

_letter: np.ndarray | None = None


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, with one blank for whatever lies between; empty without a letter."""
    global _letter
    if _letter is None:
        _letter = np.array([chr(k).isalpha() for k in range(1 << 16)])
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = _letter[np.minimum(points, (1 << 16) - 1)]
    if (high := points >= 1 << 16).any():
        kinds, which = np.unique(points[high], return_inverse=True)
        is_letter[high] = np.array([chr(k).isalpha() for k in kinds.tolist()])[which]
    if not is_letter.any():
        return points[:0]
    starts = is_letter.copy()
    starts[1:] |= is_letter[:-1]
    return np.where(is_letter, points, _BLANK)[starts]


def automaton(points: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton of a sequence: its transitions as (state, symbol, next state)."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in points:
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = steps[at][symbol]
            if length[to] != length[at] + 1:  # `to` also ends longer strings: split it
                twin = len(steps)
                steps.append(dict(steps[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = twin
                while at >= 0 and steps[at].get(symbol) == to:
                    steps[at][symbol] = twin
                    at = link[at]
                to = twin
            link[new] = to
        last = new
    rows = [(s, c, t) for s, own in enumerate(steps) for c, t in own.items()]
    return tuple(list(x) for x in zip(*rows)) if rows else ([], [], [])


@dataclass
class Parser:
    """Languages in alphabetical order with the transitions of each, over one alphabet of all learned letters.

    Symbol 0 is a letter never learned; those from `width` on have no column in the tables.
    """

    languages: list[str]
    bits: np.ndarray  # of a phrase, per language
    width: int
    known: np.ndarray  # learned code points, sorted
    codes: np.ndarray  # their symbols
    tables: list[np.ndarray]  # [state * width + symbol] -> next state, with _STOP where a new phrase begins
    rare: list[tuple[np.ndarray, np.ndarray]]  # sorted keys state * others + symbol - width, and the same

    @classmethod
    def empty(cls) -> Parser:
        return cls([], np.zeros(0), 1, np.zeros(0, np.uint32), np.zeros(0, np.uint32), [], [])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text in each language; every stretch starts a phrase of its own."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= AT_ONCE):
                size += len(texts[last])
                last += 1
            out[first:last] = self._together(texts[first:last])
            first = last
        return out

    def _together(self, texts: list[np.ndarray]) -> np.ndarray:
        width, known, codes = self.width, self.known, self.codes
        others = len(known) + 1 - width
        sizes = np.array([len(t) for t in texts])
        joined = np.concatenate(texts)
        small = np.zeros(1 << 12, np.uint32)
        small[known[known < 1 << 12]] = codes[known < 1 << 12]
        symbols = small[np.minimum(joined, (1 << 12) - 1)]
        if (high := np.flatnonzero(joined >= (1 << 12) - 1)).size:
            at = np.minimum(np.searchsorted(known, joined[high]), len(known) - 1)
            symbols[high] = np.where(known[at] == joined[high], codes[at], 0)
        has_rare = bool(others) and bool((symbols >= width).any())
        lanes = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), lanes)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = begin[owner] + nth * STRETCH
        length = np.minimum(STRETCH, begin[owner + 1] - start)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        state = np.zeros((len(self.languages), len(owner)), np.int32)
        count = np.zeros((len(self.languages), len(owner)), np.int32)
        for t in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -t, "left"))  # those longer than t
            symbol = symbols[start[:live] + t]
            seldom = np.flatnonzero(symbol >= width) if has_rare else ()
            if len(seldom):
                own = symbol[seldom].astype(np.int64) - width
                symbol[seldom] = 0
            for k, table in enumerate(self.tables):
                step = table[state[k, :live] * width + symbol.view(np.int32)]
                if len(seldom):
                    step[seldom] = self._search(k, state[k, seldom], own, others)
                count[k, :live] += step >> 30
                state[k, :live] = step & (_STOP - 1)
        return np.stack([np.bincount(owner, c, len(texts)) for c in count], axis=1).astype(np.int64)

    def _search(self, k: int, state: np.ndarray, symbol: np.ndarray, others: int) -> np.ndarray:
        """Steps by letters without a column: from the state, else from the root, where a phrase begins."""
        keys, steps = self.rare[k]
        if not len(keys):
            return np.full(len(state), _STOP, np.int32)

        def at(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return keys[place] == key, steps[place]

        found, step = at(state.astype(np.int64) * others + symbol)
        if not found.all():
            begins, root = at(symbol[~found])
            step[~found] = np.where(begins, root, _STOP)
        return step

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        cut = [letters(t) for t in texts]
        full = [k for k, c in enumerate(cut) if len(c)]
        names, scores = [NONE] * len(texts), [0.0] * len(texts)
        if full and self.languages:
            cost = self.phrases([cut[k] for k in full]) * self.bits
            best = cost.argmin(axis=1)
            sure = 1 / np.exp2(-(cost - cost.min(axis=1, keepdims=True)) / SOFT).sum(axis=1)
            for k, b, s in zip(full, best.tolist(), sure.tolist()):
                names[k], scores[k] = self.languages[b], s
        return names, scores


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: int = LEARN,
          sample: int = SAMPLE) -> Parser:
    """Learn from a bounded sample of the rows with a text and a language.

    About `sample` documents of each language, by a hash of id and text, go to one task
    per language; whole documents are taken in that order until `learn` letters are
    reached. Repeated rows count once. Only the automata come to the driver: at most two
    states a letter. NULL languages are not learned.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("at"), F.col(text_col).alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return Parser.empty()
    shares = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample / r["count"]))))
    drawn = rows.where(F.pmod("at", F.lit(1 << 20)) < shares[F.col("lang")] * (1 << 20)).dropDuplicates(["lang", "at"])

    def build(group: pa.Table) -> pa.RecordBatch | None:
        taken: list[int] = []
        for text in group.column("text"):
            if len(taken) >= learn:
                break
            if len(own := letters(text.as_py())):
                taken += [_BLANK, *own.tolist()]
        if not taken:
            return None
        steps = [np.array(x, "<u4").tobytes() for x in automaton(taken)]
        return pa.RecordBatch.from_arrays([group.column("lang").slice(0, 1).combine_chunks(), pa.array([len(taken)], pa.int64()),
                                           *(pa.array([x], pa.binary()) for x in steps)], names=["lang", "n", "s", "c", "t"])

    built = drawn.repartition("lang").sortWithinPartitions("lang", "at")
    learned = per_group(built, ["lang"], build, "lang string, n bigint, s binary, c binary, t binary", dealt=True)
    found = sorted((r["lang"], r["n"], *(np.frombuffer(r[k], "<u4") for k in "sct")) for r in learned.collect())
    if not found:
        return Parser.empty()
    points, uses = np.unique(np.concatenate([c for *_, c, _ in found]), return_counts=True)
    order = np.argsort(-uses, kind="stable")
    kept, others = np.sort(points[order[:SYMBOLS]]), np.sort(points[order[SYMBOLS:]])
    codes = np.zeros(len(points), np.uint32)
    codes[np.searchsorted(points, np.concatenate([kept, others]))] = np.arange(1, len(points) + 1)
    width, tables, rare = len(kept) + 1, [], []
    for _, _, s, c, t in found:
        s, t, symbol = s.astype(np.int64), t.astype(np.int32), codes[np.searchsorted(points, c)].astype(np.int64)
        common = symbol < width
        table = np.full((int(max(s.max(), t.max())) + 1, width), -1, np.int32)
        table[s[common], symbol[common]] = t[common]
        root = np.where(table[0] < 0, 0, table[0]) | _STOP
        table = np.where(table < 0, root, table)
        table[0] = root  # every step from the root begins a phrase
        tables.append(table.ravel())
        keys = s[~common] * len(others) + symbol[~common] - width
        steps, sort = np.where(s == 0, t | _STOP, t)[~common], np.argsort(keys)
        rare.append((keys[sort], steps[sort]))
    return Parser([r[0] for r in found], np.array([math.log2(r[1] + 1) for r in found]), width, points, codes, tables, rare)


def spoken(text: Column, parser: Parser, spark) -> Column:
    """struct(lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(parser)  # bounded by `learn`, `SYMBOLS` and the number of languages

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for some in slices(texts):
            for whole, own in zip((names, scores), shared.value.judge(some.to_pylist())):
                whole += own
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return judge(text)


def identify(docs: DataFrame, parser: Parser, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score (0 to 1, how far the other languages are off).

    NULL texts and texts without a letter are `und` with score 0, and so is everything if
    nothing was learned. Ties go to the alphabetically first language. Rows come out as they
    came in, repeated ones too; other columns are not read.
    """
    return docs.select(F.col(id_col), spoken(F.col(text_col), parser, docs.sparkSession).alias("found")).select(id_col, "found.*")
