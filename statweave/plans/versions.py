"""A table in folders by one key, of which readers see one whole version at a time.

New data of some members go to a folder of their own; an index then says which folder holds
which member, and it takes its place in one step. Members that a version does not touch keep
their files. A version that breaks off before its index is there was never seen, and the next
one writes over it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources import store
from ..sources.literals import literal_table

_INDEX = "membro int, versao int, marca int"


@dataclass(frozen=True)
class Versions:
    path: str
    key: str  # a whole number, one folder each
    schema: str  # of the other columns
    order: tuple[str, ...] = ()  # rows of a file are sorted by these, so that readers skip row groups

    def last(self, spark: SparkSession) -> int:
        return max((int(name) for name in store.children(spark, f"{self.path}/indice")), default=0)

    def index(self, spark: SparkSession) -> list[tuple[int, int, int]]:
        """(member, version that holds it, mark of the newest version): one row for each folder of the newest version."""
        if not (newest := self.last(spark)):
            return []
        rows = spark.read.schema(_INDEX).parquet(f"{self.path}/indice/{newest:08d}").collect()
        return [tuple(r) for r in rows]

    def mark(self, spark: SparkSession) -> int:
        """What the newest version has taken in, as its writer numbered it; -1 while there is none."""
        return max((mark for *_, mark in self.index(spark)), default=-1)

    def read(self, spark: SparkSession, members: Iterable[int] | None = None) -> DataFrame:
        """The newest version, or some members of it; only their folders are listed and read."""
        kinds = T.StructType.fromDDL(f"{self.schema}, versao int, `{self.key}` int")
        wanted = None if members is None else set(members)
        paths = [f"{self.path}/dados/versao={version}/{self.key}={member}" for member, version, _ in self.index(spark)
                 if wanted is None or member in wanted]
        if not paths:
            return spark.createDataFrame([], kinds).drop("versao")
        return spark.read.schema(kinds).option("basePath", f"{self.path}/dados").parquet(*paths).drop("versao")

    def publish(self, spark: SparkSession, df: DataFrame, members: Iterable[int], mark: int) -> None:
        """Replace the given members by the rows of ``df``, which holds no others; a member without rows goes.

        Rows are written by the tasks they lie in: each task leaves one file for each of its members.
        """
        replaced, version = set(members), self.last(spark) + 1
        target = f"{self.path}/dados/versao={version}"
        df.sortWithinPartitions(self.key, *self.order).write.mode("overwrite").partitionBy(self.key).parquet(target)
        written = [int(name.partition("=")[2]) for name in store.children(spark, target) if name.startswith(f"{self.key}=")]
        kept = [(member, old, mark) for member, old, _ in self.index(spark) if member not in replaced]
        entries = literal_table(spark, kept + [(member, version, mark) for member in written], _INDEX)
        staged = f"{self.path}/_indice"
        entries.coalesce(1).write.mode("overwrite").parquet(staged)
        store.move(spark, staged, f"{self.path}/indice/{version:08d}")
