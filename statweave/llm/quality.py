"""Quality of documents by hierarchical empirical Bayes over sites and paths.

A logistic classifier over cheap text statistics gives each document its own evidence. The
evidence of all other documents of its site and path is added as a prior: a path's rate is
shrunk towards its site's, and a site's towards the global rate. How much follows from the
data: the variance between groups, less what chance alone would give, says how many
documents the prior is worth. Sparse groups therefore lean on the level above.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SAMPLE = 2000  # labelled documents of each label that are learned from, at most
TINY = 1e-4

_CLASS = np.zeros(256, np.int64)  # 0 letters, 1 upper case, 2 digits, 3 blanks, 4 sentence marks, 5 other marks, 6 beyond ASCII
_CLASS[:128] = [0 if chr(k).islower() else 1 if chr(k).isupper() else 2 if chr(k).isdigit() else 3 if chr(k).isspace()
                else 4 if chr(k) in ".,;:?'\"-()" else 5 for k in range(128)]
_CLASS[128:] = 6
FEATURES = 12


def features(text: str | None) -> np.ndarray:
    """Constant, log length, shares of character classes, word length, share of distinct words and lines, words a line."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(_CLASS, np.bincount(np.frombuffer(data, np.uint8), minlength=256), 7)
    words, lines = data.split(), data.splitlines()
    n, w, k = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    return np.array([1.0, math.log1p(len(data)), *(counts[1:] / n), len(data) / w, len(set(words)) / w, len(set(lines)) / k, math.log(w / k)])


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    rate: float

    def chance(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = (np.array([features(t) for t in texts]) - self.mean) / self.scale
        return np.clip(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))), TINY, 1 - TINY)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE) -> Classifier:
    """Fit on at most `sample` labelled documents of each label, by a hash of their id; weighted to the rate of all labels.

    Without rows of both labels every document has the rate of the label (one half without any).
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(F.col(label_col).cast("int")).alias("label"))
    counts = dict(marked.groupBy("label").count().collect())
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.5
    flat = Classifier(np.zeros(FEATURES), np.ones(FEATURES), np.eye(FEATURES)[0] * math.log((rate + TINY) / (1 - rate + TINY)), rate)
    if not counts.get(0) or not counts.get(1):
        return flat
    few = [marked.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(sample) for k in (0, 1)]
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(few[0].union(few[1])), "id").dropDuplicates(["id"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), batch.column("label"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["id", "label", "x"])

    rows = sorted(chosen.select("id", "text", "label").mapInArrow(measure, "id bigint, label int, x array<double>").collect())
    y = np.array([r["label"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return flat
    x = np.array([r["x"] for r in rows])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    mean[0], scale[0] = 0.0, 1.0
    x = (x - mean) / scale
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    w, ridge = np.zeros(FEATURES), np.diag([1e-6] + [1.0] * (FEATURES - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
    return Classifier(mean, scale, w, rate)


def _worth(groups: DataFrame, n: str, s: str, center: str) -> float:
    """How many documents the level above is worth: from the spread of group means beyond that of chance."""
    mean = F.col(s) / F.col(n)
    row = groups.where(F.col(n) > 1).agg(
        F.sum(n).alias("n"), F.sum(F.col(n) * (mean - F.col(center)) ** 2).alias("spread"),
        F.sum(F.col(center) * (1 - F.col(center))).alias("chance"), F.sum(F.col(n) * F.col(center) * (1 - F.col(center))).alias("whole")).first()
    if not row["n"]:
        return 10.0
    between = (row["spread"] - row["chance"]) / row["n"]
    return float(min(1e6, max(1.0, row["whole"] / row["n"] / between - 1))) if between > 1e-9 else 1e6


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def assess(docs: DataFrame, model: Classifier, site: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, evidence (of the text alone), site_rate, path_rate (of the others there), posterior, keep (from 0.5 on).

    The rates of a document leave itself out, so nothing counts twice. NULL sites and paths
    are groups of their own; NULL and empty texts have the evidence of an empty text.
    Repeated rows count and come out as often as they came in. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.to_json(F.struct(site.cast("string").alias("s"))).alias("site"),
                       F.to_json(F.struct(site.cast("string").alias("s"), path.cast("string").alias("p"))).alias("path"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.chance(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("id", "site", "path")), pa.array(p)], names=["id", "site", "path", "p"])

    judged = written(rows.mapInArrow(evidence, f"id {kind}, site string, path string, p double"), "evidence")
    # Sums of whole millionths do not depend on the order of the rows.
    paths = written(judged.groupBy("site", "path").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.round(F.col("p") * 1_000_000).cast("long")) / 1_000_000).alias("s")), "paths")
    sites = paths.groupBy("site").agg(F.sum("n").alias("site_n"), F.sum(F.round(F.col("s"), 6).cast("decimal(28,6)")).cast("double").alias("site_s"))
    whole = sites.agg(F.sum("site_n"), F.sum(F.col("site_s").cast("decimal(28,6)")).cast("double")).first()
    center = whole[1] / whole[0] if whole[0] else model.rate
    sites = sites.withColumn("center", F.lit(min(max(center, TINY), 1 - TINY)))
    above = _worth(sites, "site_n", "site_s", "center")
    sites = sites.withColumn("shrunk", (F.col("site_s") + above * F.col("center")) / (F.col("site_n") + above))
    levels = paths.join(sites, "site")
    between = _worth(levels, "n", "s", "shrunk")
    out = judged.join(levels.drop("site"), "path")
    site_rate = (F.col("site_s") - F.col("p") + above * F.col("center")) / (F.col("site_n") - 1 + above)
    path_rate = (F.col("s") - F.col("p") + between * F.col("site_rate")) / (F.col("n") - 1 + between)
    near = lambda c: F.least(F.greatest(c, F.lit(TINY)), F.lit(1 - TINY))
    out = out.withColumn("site_rate", near(site_rate)).withColumn("path_rate", near(path_rate))
    total = _logit(F.col("p")) + _logit(F.col("path_rate")) - _logit(F.col("center"))
    posterior = F.round(1 / (1 + F.exp(-total)), 9)
    return out.select(F.col("id").alias(id_col), F.round("p", 9).alias("evidence"), F.round("site_rate", 9).alias("site_rate"),
                      F.round("path_rate", 9).alias("path_rate"), posterior.alias("posterior"), (posterior >= 0.5).alias("keep"))
