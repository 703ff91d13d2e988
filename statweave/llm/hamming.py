"""Exact nearest binary codes by incremental multi-index hashing.

Vectors become sign bits. A code is cut into segments of 16 bits, and an index keeps, per
segment, the codes with each value. A query looks up its segments' values, then those that
differ in one bit, in two, and so on. After radius r every code that is nearer than
m * (r + 1) bits has been seen, m being the number of segments; the search ends when the
k-th distance found is below that. No code is missed and none need be compared beyond that.

Equal codes are one entry with its smallest ids. Entries lie in blocks, queries too, and a
task searches one block for one block of queries; the best of every block are merged.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import per_group

SEGMENT = 16
ENTRIES, QUERIES = 16_384, 1024  # codes in a block


def _masks(radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), radius)], np.int64)


class Block:
    """Codes (rows of 16-bit segments) with how many ids each stands for."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.codes, self.sizes = codes, sizes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.first = [np.searchsorted(c[o], np.arange((1 << SEGMENT) + 1)) for c, o in zip(codes.T, self.order)]
        self.masks: list[np.ndarray] = []

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of all codes up to the k-th id's distance."""
        n, m = self.codes.shape
        seen, found, far = np.zeros(n, bool), [], []
        for radius in range(SEGMENT + 1):
            if len(self.masks) <= radius:
                self.masks.append(_masks(radius))
            masks = self.masks[radius]
            if len(masks) * m >= n:  # as many values to look up as codes: all that are left are compared
                fresh, covered = np.flatnonzero(~seen), m * SEGMENT
            else:
                hits = []
                for s in range(m):
                    values = masks ^ int(query[s])
                    low, high = self.first[s][values], self.first[s][values + 1]
                    some = high > low
                    hits += [self.order[s][a:b] for a, b in zip(low[some].tolist(), high[some].tolist())]
                fresh = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
                fresh, covered = fresh[~seen[fresh]], m * (radius + 1) - 1
            if len(fresh):
                seen[fresh] = True
                found.append(fresh)
                far.append(np.bitwise_count(self.codes[fresh] ^ query).sum(axis=1, dtype=np.int64))
            if found:
                rows, distance = np.concatenate(found), np.concatenate(far)
                order = np.argsort(distance, kind="stable")
                enough = np.cumsum(self.sizes[rows[order]]) >= k
                if enough.any() and distance[order[int(enough.argmax())]] <= covered:
                    within = distance <= distance[order[int(enough.argmax())]]
                    return rows[within], distance[within]
            if covered == m * SEGMENT:
                break
        return (np.concatenate(found), np.concatenate(far)) if found else (np.zeros(0, np.int64),) * 2


def signs(vector: Column, width: int) -> Column:
    """Sign bits of a vector as bytes; missing and NULL components count as not positive. NULL for a NULL vector."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        out = []
        for v in vectors.to_pylist():
            if v is None:
                out.append(None)
                continue
            bits = np.zeros(width, np.uint8)
            bits[:len(v)] = [x is not None and x > 0 for x in v]
            out.append(np.packbits(bits).tobytes())
        return pa.array(out, pa.binary())

    return pack(vector)


def nearest(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, neighbor_id, distance): for each row that `queries` picks, the k nearest other ids, ties by id.

    Rows with a NULL id or vector take no part; repeated rows count once. Vectors of
    different lengths are compared as if the shorter ones went on with zeros. Fewer than k
    other ids give fewer rows. Other columns are not read.
    """
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    width = rows.agg(F.max(F.size(vector_col))).first()[0] or 1
    width = -(-width // SEGMENT) * SEGMENT
    coded = rows.select(F.col(id_col).alias("id"), queries.alias("asks"), signs(F.col(vector_col), width).alias("code")).distinct()
    # Of one code's ids the k + 1 smallest can be answers (one may be the query itself).
    few = coded.withColumn("nth", F.row_number().over(W.partitionBy("code").orderBy("id"))).where(F.col("nth") <= k + 1)
    entries = few.groupBy("code").agg(F.count(F.lit(1)).alias("ids"))
    asked = coded.where("asks").select("code").distinct()
    blocks = [max(1, -(-df.count() // size)) for df, size in ((entries, ENTRIES), (asked, QUERIES))]
    at = F.pmod(F.xxhash64("code"), F.lit(blocks[0])).cast("int")
    of = F.pmod(F.xxhash64("code", F.lit(1)), F.lit(blocks[1])).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    both = entries.select("code", "ids", at.alias("lo"), spread(blocks[1]).alias("hi")).union(
        asked.select("code", F.lit(0).cast("long"), spread(blocks[0]), of))

    def search(group: pa.Table) -> pa.RecordBatch | None:
        ids = group.column("ids").to_numpy()
        names = group.column("code").to_pylist()
        codes = np.frombuffer(b"".join(names), ">u2").reshape(len(names), -1).astype(np.uint16)
        own, ask = np.flatnonzero(ids > 0), np.flatnonzero(ids == 0)
        if not len(own) or not len(ask):
            return None
        block, out = Block(codes[own], ids[own]), []
        for q in ask.tolist():
            found, distance = block.nearest(codes[q], k + 1)
            out += [(names[q], names[own[r]], d) for r, d in zip(found.tolist(), distance.tolist())]
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary()),
                                           pa.array([o[2] for o in out], pa.int32())], names=["asked", "code", "distance"])

    near = per_group(both, ["lo", "hi"], search, "asked binary, code binary, distance int")
    pairs = near.join(few.select("code", F.col("id").alias("neighbor_id")), "code").join(
        coded.where("asks").select(F.col("code").alias("asked"), F.col("id").alias("query_id")), "asked").where("neighbor_id <> query_id")
    best = W.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
