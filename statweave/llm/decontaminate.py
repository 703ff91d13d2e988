"""Benchmark items inside training texts: BM25 over an inverted index of the items, block-max WAND, verification.

Every passage of every text is a query against the items. Weights are BM25 divided by the
item's score for its own text, so 1 means that the passage says all of the item, and one
threshold serves items of every length. Items lie in blocks; the index keeps each word's
largest weight in each block. Per passage the maxima of its words are summed per block, and
only blocks whose sum can reach the threshold have their items scored. Words that most
items share add little and are counted as if every passage had them.

A passage is two neighbouring stretches of words, each as long as the longest item of its
length class, so wherever an item stands it lies whole in one passage. An item is reported
if the passage scores above the threshold and repeats runs of three words of its question
(all but the last sentence) and of its answer (the last sentence).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.6, 0.5
RUN = 3  # words of a run
BLOCK = 4  # items
STRETCH = 64  # words; longer items have a class with twice the length, and so on
ITEMS = 20_000  # of one index; more items make more indexes, each applied to all texts
COMMON = 0.1  # share of items beyond which a word counts as common
CELLS = 1 << 22  # passages times blocks weighed at once
WORD = re.compile(r"\w+")
FOUND = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def parts_of(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer; both the same where there is one sentence only."""
    sentences = [w for s in re.split(r"(?<=[.!?])\s+|\n", text) if (w := words_of(s))]
    if len(sentences) < 2:
        return words_of(text), words_of(text)
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def _runs(words: list[str]) -> set[tuple[str, ...]]:
    size = min(RUN, len(words))
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if words else set()


@dataclass
class Item:
    item_id: int
    weights: dict[str, float]
    question: set[tuple[str, ...]]
    answer: set[tuple[str, ...]]


class Index:
    """Inverted index with block maxima over the items of one length class."""

    def __init__(self, stretch: int, items: list[Item], common: set[str]):
        self.stretch = stretch
        self.blocks = [items[k:k + BLOCK] for k in range(0, len(items), BLOCK)]
        self.given = np.zeros(len(self.blocks))  # what common words can add
        self.terms: dict[str, int] = {}
        postings: list[dict[int, float]] = []
        for b, block in enumerate(self.blocks):
            for item in block:
                self.given[b] = max(self.given[b], sum(x for w, x in item.weights.items() if w in common))
                for word, weight in item.weights.items():
                    if word not in common:
                        term = self.terms.setdefault(word, len(self.terms))
                        if term == len(postings):
                            postings.append({})
                        postings[term][b] = max(postings[term].get(b, 0.0), weight)
        self.first = np.cumsum([0] + [len(p) for p in postings])
        self.block = np.array([b for p in postings for b in p], np.int64)
        self.most = np.array([x for p in postings for x in p.values()])

    def reachable(self, texts: list[list[str]]) -> list[tuple[int, int, int]]:
        """(text, passage, block) whose block maxima reach the threshold; passage k starts with stretch k."""
        out, find, nb = [], self.terms.get, len(self.blocks)
        per = max(1, CELLS // nb)
        first = 0
        while first < len(texts):
            last, count = first, 0
            while last < len(texts) and (last == first or count + len(texts[last]) // self.stretch + 1 <= per):
                count += len(texts[last]) // self.stretch + 1
                last += 1
            for begin in range(0, count, per) if last == first + 1 else (0,):  # a very long text in pieces
                out += self._weigh(texts, first, last, find, begin, min(count, begin + per) if last == first + 1 else count)
            first = last
        return out

    def _weigh(self, texts: list[list[str]], first: int, last: int, find, begin: int, end: int) -> list[tuple[int, int, int]]:
        owner, place, terms = [], [], []
        nb, base = len(self.blocks), 0
        for t in range(first, last):
            words = texts[t]
            count = len(words) // self.stretch + 1
            low = begin * self.stretch if last == first + 1 else 0
            words = words[low:(end + 1) * self.stretch] if last == first + 1 else words
            ids = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
            at = np.flatnonzero(ids >= 0)
            place.append(at // self.stretch + base)
            terms.append(ids[at])
            if last == first + 1:
                owner += [(t, begin + k) for k in range(end - begin + 1)]
                base += end - begin + 1
            else:
                owner += [(t, k) for k in range(count)]
                base += count
        # A word counts once in a stretch.
        place_, terms_ = np.divmod(np.unique(np.concatenate(place) * len(self.first) + np.concatenate(terms)), len(self.first))
        sizes = self.first[terms_ + 1] - self.first[terms_]
        rows = np.repeat(self.first[terms_] - np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes, sizes) + np.arange(sizes.sum())
        sums = np.bincount(np.repeat(place_, sizes) * nb + self.block[rows], self.most[rows], base * nb).reshape(base, nb)
        both = sums.copy()
        both[:-1] += sums[1:]
        edge = np.array([k + 1 < len(owner) and owner[k + 1][0] == owner[k][0] for k in range(len(owner))])
        both[~edge] = sums[~edge]
        if last == first + 1 and end * self.stretch < len(texts[first]):
            both = both[:-1]  # the next piece starts with the last stretch
        return [(*owner[p], int(b)) for p, b in zip(*np.nonzero(both + self.given >= THRESHOLD))]

    def matches(self, texts: list[list[str]], out: list[dict[int, tuple[float, float, float]]]) -> None:
        now, said, runs = (-1, -1), set(), set()
        for text, passage, block in self.reachable(texts):
            if (text, passage) != now:
                now = (text, passage)
                words = texts[text][passage * self.stretch:(passage + 2) * self.stretch]
                said, runs = set(words), None
            for item in self.blocks[block]:
                score = sum(x for w, x in item.weights.items() if w in said)
                if score >= THRESHOLD:
                    runs = _runs_all(words) if runs is None else runs
                    asked, told = (len(p & runs) / len(p) for p in (item.question, item.answer))
                    if asked >= OVERLAP and told >= OVERLAP:
                        out[text][item.item_id] = max(out[text].get(item.item_id, (0.0, 0.0, 0.0)), (score, asked, told))


def _runs_all(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of every length up to RUN: items shorter than a run are their own run."""
    return {tuple(words[k:k + size]) for size in range(1, RUN + 1) for k in range(len(words) - size + 1)}


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", per_index: int = ITEMS) -> list[list[Index]]:
    """Indexes of bounded size over all items; one inner list per `per_index` items, one Index per length class.

    Word counts and lengths are taken over all items. Items without an id or a word are left
    out; repeated items count once.
    """
    spark = items.sparkSession

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([words_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).dropDuplicates().withColumn(
        "words", cut("text")).where("id IS NOT NULL AND size(words) > 0")
    rows = written(rows, "items")
    n, mean = rows.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    if not n:
        return []
    spread = rows.select("id", F.explode(F.array_distinct("words")).alias("word"))
    df = written(spread.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "df")
    shares, out = -(-n // per_index), []
    for share in range(shares):
        own = rows.where(F.pmod(F.xxhash64("id"), F.lit(shares)) == share)
        counts = dict(df.join(own.select(F.explode("words").alias("word")).distinct(), "word").collect())
        classes: dict[int, list[Item]] = {}
        for r in own.orderBy("id", "text").toLocalIterator():
            length, item = len(r["words"]), {}
            for word, tf in Counter(r["words"]).items():
                idf = math.log(1 + (n - counts[word] + 0.5) / (counts[word] + 0.5))
                item[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
            total = sum(item.values())
            question, answer = map(_runs, parts_of(r["text"]))
            stretch = STRETCH << max(0, math.ceil(math.log2(length / STRETCH)))
            classes.setdefault(stretch, []).append(Item(r["id"], {w: x / total for w, x in item.items()}, question, answer))
        common = {w for w, c in counts.items() if c > max(1, COMMON * n)}
        out.append([Index(stretch, items_, common) for stretch, items_ in sorted(classes.items())])
    return [[_shared(spark, i) for i in own] for own in out if own]


def _shared(spark, index: Index):
    return spark.sparkContext.broadcast(index)  # at most `per_index` items


def leaks(text: Column, found: list) -> Column:
    """array of struct(item_id, score, question, answer): the items of one group of indexes that a text holds."""

    @F.arrow_udf(FOUND)
    def look(texts: pa.Array) -> pa.Array:
        hits: list[dict[int, tuple[float, float, float]]] = []
        for some in slices(texts):
            cut = [words_of(t) for t in some.to_pylist()]
            own: list[dict[int, tuple[float, float, float]]] = [{} for _ in cut]
            for index in found:
                index.value.matches(cut, own)
            hits += own
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))
        return pa.array([[{"item_id": i, "score": s, "question": q, "answer": a} for i, (s, q, a) in sorted(h.items())] for h in hits], kind)

    return look(text)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs` and item in its text: id, item_id, score, question_overlap, answer_overlap.

    NULL and empty texts hold nothing, and nothing is found without items. Repeated rows are
    reported each. Other columns are not read.
    """
    out = docs.select(F.col(id_col), F.lit(None).cast(FOUND).alias("hit")).where("false")
    for group in indexes(items):
        out = out.union(docs.select(F.col(id_col), leaks(F.col(text_col), group).alias("hit")))
    return out.select(id_col, F.explode("hit").alias("hit")).select(
        id_col, "hit.item_id", F.col("hit.score").alias("score"), F.col("hit.question").alias("question_overlap"),
        F.col("hit.answer").alias("answer_overlap"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item, all columns as they were; NULL and empty texts stay."""
    for group in indexes(items):
        docs = docs.where(F.size(leaks(F.col(text_col), group)) == 0)
    return docs
