"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into 2**BITS ranges at its own quantiles; the ranges are the
coordinates of a cell, and cells are ordered along a Hilbert curve, whose neighbours are
close in every dimension. The curve is cut into runs with equally many rows, so that each
shard covers a small box and a reader can skip shards by the least and largest value of any
dimension.

Ranks need no total sort: a cell's rows are split by hash into buckets of bounded size, the
counts of buckets are summed up along the curve, and rows are numbered inside their bucket.
A cell with a third of all rows is many buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

BITS = 5
BUCKET = 20_000  # rows
ACCURACY = 10_000


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (one row each), each coordinate of `bits` bits."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of the larger cells
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def as_number(c: Column, kind: str) -> Column:
    """A number in the order of the column's values: strings by their first six bytes. NULL is least."""
    if kind == "string":
        number = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    else:
        number = c.cast("double")
    return F.coalesce(number, F.lit(float("-inf")))


def shards(docs: DataFrame, count: int, dimensions: list[str], id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """Per row: id, size (UTF-8 bytes of the text and 8), text_crc32, shard (0 to count - 1), slot in it, curve position.

    Shards differ by one row at most. Dimensions are column names of `docs`; NULLs come
    first in each. A NULL text has no bytes and the checksum of an empty one. Repeated rows
    get a slot each; rows of one bucket are in the order of id, size and checksum. Fewer rows
    than shards leave the last shards empty. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = dict(docs.dtypes)
    names = [f"d{k}" for k in range(len(dimensions))]
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        *(as_number(F.col(d), kinds[d]).alias(n) for d, n in zip(dimensions, names)))
    rows = written(rows, "sizes")
    steps = [k / 2**bits for k in range(1, 2**bits)]
    cuts = rows.agg(*(F.percentile_approx(n, steps, ACCURACY).alias(n) for n in names)).first()
    total = rows.count()
    if not total:
        return rows.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("curve"))
    for n in names:
        levels = sorted({c for c in cuts[n] if c > float("-inf")})
        passed = [F.when(F.col(n) >= c, 1).otherwise(0) for c in levels]
        rows = rows.withColumn(n, sum(passed, F.lit(0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(points, bits))], names=[*batch.schema.names, "curve"])

    kinds_ = ", ".join(f"{n} int" for n in names)
    cells = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).mapInArrow(place, f"{kinds_}, n bigint, curve bigint")
    cells = written(cells, "cells")  # at most 2**(bits * dimensions) rows
    split = rows.join(F.broadcast(cells), names) if bits * len(names) <= 16 else rows.join(cells, names)
    bucketed = split.select("id", "size", "crc", "curve", F.pmod(F.xxhash64("id", "crc"), F.ceil(F.col("n") / BUCKET)).alias("bucket"))
    counts = bucketed.groupBy("curve", "bucket").agg(F.count(F.lit(1)).alias("n"))
    along = W.orderBy("curve", "bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per bucket
    offsets = counts.select("curve", "bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = W.partitionBy("curve", "bucket").orderBy("id", "size", "crc")
    ranked = bucketed.join(offsets, ["curve", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    shard = F.expr(f"(rank * {count}) div {total}")
    first = F.expr(f"(((rank * {count}) div {total}) * {total} + {count - 1}) div {count}")
    return ranked.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), shard.cast("int").alias("shard"),
                         (F.col("rank") - first).cast("long").alias("slot"), "curve")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Write the rows of `docs` under path/shard=k in slot order, for ids that are unique; returns rows per shard."""
    columns = docs.columns
    joined = docs.join(placed.select(F.col(id_col), F.col("shard").alias("__shard"), F.col("slot").alias("__slot")), id_col)
    dealt = joined.repartition("__shard").sortWithinPartitions("__shard", "__slot").withColumn("shard", F.col("__shard"))
    dealt.select(*(c for c in columns if c != "shard"), "shard").write.partitionBy("shard").parquet(path)
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
