"""Compression of vectors to part codes, exact in whole numbers.

A vector is cut into equal parts and each part is replaced by the index of its nearest entry
in a codebook for that position. Codebooks start from the vectors with the least ids and are
improved by a fixed number of rounds: assign all parts, then move every entry to the mean of
its parts, rounded down.

Within a batch, the distinct parts of a position form a lexicographic trie: a node at depth
t stands for the first t components, and holds the squared distances of that prefix to all
entries. A child adds the table column of its own component, so parts with a common prefix
share the work. The walk goes depth first, over blocks of siblings of bounded size; at a leaf the least
sum tells the entry, and the part counts with the number of its repetitions.

A round is one pass over the vectors. Each batch emits a count and a sum for each entry, which
Spark adds up; only codebooks (parts x entries rows) ever come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
NODES = 4096  # siblings expanded together
FAR = 1 << 53  # larger components count as this
SALTS = 32


class Trie:
    """Distinct parts of one position, in lexicographic order, against a codebook."""

    def __init__(self, parts: np.ndarray, entries: np.ndarray):
        self.parts = parts
        far = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
        exact = 4 * far * far * max(1, parts.shape[1]) < 1 << 63  # beyond that Python's whole numbers are needed
        self.entries = entries if exact else entries.astype(object)
        differs = parts[1:] != parts[:-1]
        # The depth at which a part leaves the one before it; the first starts at the root.
        self.leaves_at = np.r_[0, differs.argmax(axis=1)] if len(parts) else np.zeros(0, np.int64)
        self.code = np.zeros(len(parts), np.int64)
        self.error = np.zeros(len(parts), self.entries.dtype)
        self.shared = 0  # nodes whose distances were computed, for tests
        if len(parts):
            self._down(np.array([0]), np.array([len(parts)]), np.zeros((1, len(entries)), self.entries.dtype), 0)

    def _down(self, first: np.ndarray, end: np.ndarray, sums: np.ndarray, depth: int) -> None:
        """Go on from nodes with rows first[i] to end[i] - 1 and distances sums[i]."""
        if depth == self.parts.shape[1]:
            best = sums.argmin(axis=1)  # ties go to the lower index
            self.code[first], self.error[first] = best, sums[np.arange(len(best)), best]
            return
        rows = np.arange(first[0], end[-1])
        starts = rows[self.leaves_at[rows] <= depth]
        ends = np.r_[starts[1:], end[-1]]
        parent = np.searchsorted(first, starts, "right") - 1
        for at in range(0, len(starts), NODES):
            some = slice(at, at + NODES)
            gap = self.parts[starts[some], depth].astype(self.entries.dtype)[:, None] - self.entries[None, :, depth]
            self.shared += len(gap)
            self._down(starts[some], ends[some], sums[parent[some]] + gap * gap, depth + 1)


def assigned(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each row, by the trie over the distinct rows."""
    distinct, back = np.unique(parts, axis=0, return_inverse=True)
    trie = Trie(distinct, entries)
    return trie.code[back.ravel()], trie.error[back.ravel()]


def weighted_sums(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries that were used, how many rows each has, and the sum of them."""
    distinct, weight = np.unique(parts, axis=0, return_counts=True)
    code = Trie(distinct, entries).code
    order = np.argsort(code, kind="stable")
    used, first = np.unique(code[order], return_index=True)
    big = int(np.abs(parts).max(initial=0)) * len(parts) >= 1 << 62
    sums = (distinct * weight[:, None].astype(object if big else np.int64))[order]
    return used, np.add.reduceat(weight[order], first), np.add.reduceat(sums, first, axis=0)


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of each component; NULL for a NULL vector or one with a NULL or not finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    limit = float(FAR)
    coded = F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * SCALE))))
    return F.when(vector.isNotNull() & ~bad, coded)


def _rows(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def learned(vectors: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks [part, entry, component] of (id, v): whole vectors with `dims` components."""
    least = vectors.where("id IS NOT NULL").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").limit(entries).collect()
    size = dims // parts
    books = np.array([r.v for r in least], np.int64).reshape(-1, parts, size).transpose(1, 0, 2)
    if not books.shape[1]:
        return books

    for _ in range(rounds):
        def work(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                cut = _rows(batch.column("v"), dims).reshape(-1, parts, size)
                for p in range(parts):
                    used, count, sums = weighted_sums(cut[:, p], books[p])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(count),
                        pa.array([[str(x) for x in s] for s in sums.tolist()], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

        found = vectors.select("v").mapInArrow(work, "part int, entry int, n bigint, sums array<string>")
        wide = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(size)]
        books = books.copy()
        for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():  # parts x entries rows
            books[row.part, row.entry] = [int(row[f"s{k}"]) // row.n for k in range(size)]
    return books


def digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id",
               vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector that is whole.

    Rows whose vector is NULL or has a NULL or not finite component are left out. The number of
    dimensions is that of the vector with the least id (ties: the longest); vectors of another
    length, or of one that cannot be cut into `parts`, have no code and no error and teach
    nothing. Codebooks start from the vectors of the least different ids (an id that comes
    repeatedly: its least vector; NULL ids never); with fewer ids there are fewer entries, and
    with none no code. label_error adds up the errors of all rows with an equal label, NULL
    labels together. Errors beyond a long are NULL. Components of 2**45 or more count as 2**45.
    Repeated rows come out as often as they came in; other columns are not read.
    """
    spark = vectors.sparkSession
    kept = written(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole_numbers(F.col(vector_col)).alias("v"))
                   .where("v IS NOT NULL"), "whole")
    first = kept.where("id IS NOT NULL").select(F.min(F.struct("id", (-F.size("v")).alias("n"))).alias("m")).first().m
    dims = -first.n if first else 0
    fits = dims > 0 and dims % parts == 0
    books = learned(kept.where(F.size("v") == dims), dims, parts, entries, rounds) if fits else np.zeros((parts, 0, 0), np.int64)
    ready = fits and books.shape[1] > 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            sized = np.flatnonzero(batch.column("v").value_lengths().to_numpy() == dims) if ready else np.zeros(0, np.int64)
            if len(sized):
                cut = _rows(batch.column("v").take(pa.array(sized)), dims).reshape(len(sized), parts, dims // parts)
                found = [assigned(cut[:, p], books[p]) for p in range(parts)]
                code = np.stack([c for c, _ in found], axis=1).tolist()
                codes[sized] = ["".join(f"{c:02x}" for c in row) for row in code]
                errors[sized] = [str(sum(e)) for e in zip(*(e.tolist() for _, e in found))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.string()),
                                              pa.array(np.arange(batch.num_rows, dtype=np.int32) % SALTS)], names=["id", "label", "code", "wide", "salt"])

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    coded = written(kept.mapInArrow(work, f"id {kinds['id']}, label {kinds['label']}, code string, wide string, salt int"), "coded").withColumn(
        "wide", F.col("wide").cast("decimal(38,0)"))
    # One row a label, dealt to several places, so that the rows of a label that is everywhere do not meet in one task.
    totals = coded.groupBy("label").agg(F.sum("wide").alias("total")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = coded.alias("c").join(totals.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label")) & (F.col("c.salt") == F.col("t.salt")))
    digest_of = digest(books) if ready else None
    return both.select(F.col("c.id").alias(id_col), "c.code", F.expr("try_cast(c.wide AS bigint)").alias("error"),
                       F.expr("try_cast(t.total AS bigint)").alias("label_error"), F.lit(digest_of).cast("string").alias("codebooks_sha256"))
