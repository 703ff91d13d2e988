"""What the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path


CROWDED = 1000  # links of a node beyond which its rows are dealt to many tasks


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder: computed once, and no executor's loss undoes it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*columns: Column) -> Column:
    """16 bytes that tell rows apart by these columns; NULL differs from every value. Equal rows share a key."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]
    sizes = [F.length(p).cast("string") for p in parts[:-1]]
    return F.unhex(F.md5(F.concat_ws("\x00", *sizes, *parts)))


def slices(batch: pa.RecordBatch | pa.Array, rows: int = 1000) -> Iterator:
    """A batch in pieces: words of many texts at once take far more memory than the texts."""
    return (batch.slice(at, rows) for at in range(0, len(batch), rows))


class Cache(dict):
    """Words a worker has coded and their ids as bytes. Beyond `limit` bytes, `make_room` forgets the older half."""

    ENTRY = 200  # bytes of an entry besides its characters and ids, about

    def __init__(self, limit: int):
        self.limit, self.bytes = limit, 0

    def make_room(self) -> None:
        if self.bytes > self.limit:
            for word in list(islice(self, len(self) // 2)):
                del self[word]
            self.bytes = self._size(self, self.values())

    def learn(self, words: list[str], ids: list[bytes]) -> None:
        self.update(zip(words, ids))
        self.bytes += self._size(words, ids)

    def _size(self, words: Iterable[str], ids: Iterable[bytes]) -> int:
        n = [len(w) for w in words]
        return self.ENTRY * len(n) + sum(n) + sum(map(len, ids))

    def missing(self, texts: Iterable[Iterable[str]]) -> list[str]:
        """Words of the texts that are not known yet, each once."""
        new: set[str] = set()
        for words in texts:
            new.update(filterfalse(self.__contains__, words))
        return list(new)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finalizer of a common public hash); changes its argument in place."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by `keys` come in batches; give the rows of each key together, also across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        starts = [0] + [i for i in range(1, len(values)) if values[i] != values[i - 1]]
        for start, end in zip(starts, [*starts[1:], len(values)]):
            if held and values[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = values[start]
    if held:
        yield pa.Table.from_batches(held)


def per_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str,
              dealt: bool = False) -> DataFrame:
    """Apply `work` to each group of bounded size. Many tiny groups share one Python call per batch of rows.

    `dealt` says that rows lie by `keys` and sorted already. Groups are dealt to as many tasks as
    the session names for shuffles: Python's work does not follow the few bytes of its input.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, keys):
            if (out := work(group)) is not None and out.num_rows:
                yield out

    return (df if dealt else df.repartition(tasks, *keys).sortWithinPartitions(*keys)).mapInArrow(over, schema)


def join_crowded(rows: DataFrame, heads: DataFrame, key: str, by: str, limit: int, salts: int = 32) -> DataFrame:
    """rows.join(heads, key), `heads` having one row for each key and `size`, how many of `rows` it has.

    The rows of keys with more than `limit` rows are dealt by `by` to many tasks, each with a
    copy of the key's row, so that no task gets all rows of one key.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    crowded = heads.where(F.col("size") > limit).withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    few = salted.join(crowded.select(key, "__salt"), [key, "__salt"], "left_anti").join(heads.where(F.col("size") <= limit), key)
    return few.drop("__salt").unionByName(salted.join(crowded, [key, "__salt"]).drop("__salt"))


def in_block_pairs(df: DataFrame, group: str, size: Column, member: str, rows: int) -> DataFrame:
    """Copy each row to the pairs of blocks its group is cut into, about `rows` rows a block.

    Adds lo, hi (the pair of blocks) and block (the row's own). Any two rows of a group
    meet in one pair; no task gets more than two blocks, however large the group is.
    """
    blocks = F.ceil(size / rows).cast("int")
    return (
        df.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
        .drop("other", "blocks")
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges (a, b): root is the least node that links reach.

    Alternates two steps on the edge table, each a minimum per node and a join: hang
    larger neighbours on the least one, then smaller ones. Paths shrink at a logarithmic
    rate, no node's neighbours are ever gathered, and every round is a written table.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = mark
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count(F.lit(1)).alias("size"))
        large = join_crowded(both, least, "a", "b", CROWDED).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("size"))
        small = join_crowded(large, low, "a", "b", CROWDED).select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select("e.*").where("a <> b").distinct(), "links")
