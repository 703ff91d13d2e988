"""Small literal tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}


def literal_table(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """Rows written in the program, as a table whose exact size the optimizer knows.

    An Arrow table becomes a local relation, so Spark decides from its true size
    whether a join may broadcast it; a plain row list would count as unknown (huge).
    """
    names, types = zip(*(part.split() for part in ddl.split(",")))
    columns = list(zip(*rows)) or [()] * len(names)
    arrays = [pa.array(list(values), type=_ARROW[kind]) for values, kind in zip(columns, types)]
    return spark.createDataFrame(pa.table(dict(zip(names, arrays))))
