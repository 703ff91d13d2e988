"""Incremental ingestion with a ledger: what landed, in which lot, with how many rows.

New files are found by name, so only their footers are read. Files are grouped by the types
their columns have, each group is read with its own types and turned into text, and what the
declared columns cannot hold goes to the rescue column. A lot is written as a folder of its
own and then entered in the ledger; readers see the lots that the ledger has, so a lot that
breaks off is invisible and is written again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import expect_report
from ..sources import files, store
from ..sources.literals import literal_table

AUDIT = ["_arquivo_origem", "_ingerido_em"]
LOT = "_lote"
_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class Feed:
    """A landing folder and the bronze folder it goes to."""

    landing: str
    bronze: str
    columns: Sequence[str]  # declared, all text
    folders: Mapping[str, str] = field(default_factory=dict)  # columns that folder names give, with their types
    max_files: int = 1000  # of a lot
    typed: Callable[[DataFrame], DataFrame] | None = None  # what the checks look at, from the rows of a lot
    checks: Mapping[str, Column] = field(default_factory=dict)

    @property
    def declared(self) -> T.StructType:
        return files.text_schema(self.columns, **self.folders)


def scan_groups(spark: SparkSession, paths: Sequence[str], root: str, folders: Mapping[str, str] | None = None) -> DataFrame:
    """The files as text, whatever types their columns have, with provenance and the typed columns of folder names."""
    folders, tables = folders or {}, []
    for schema, some in files.schema_groups(spark, paths):
        if clash := [f.name for f in schema if f.name in folders]:
            raise ValueError(f"columns both in folder names and in files under {root}: {', '.join(clash)}")
        typed = T.StructType([*schema.fields, *files.text_schema([], **folders).fields]) if folders else schema
        reader = spark.read.schema(typed)
        reader = reader.option("basePath", root) if folders else reader.option("recursiveFileLookup", "true")
        tables.append(files.as_text(files.with_audit(reader.parquet(*some)), keep=[*folders, *AUDIT]))
    return files.union_by_name(*tables)


def ingest(spark: SparkSession, feed: Feed) -> int:
    """Read what has landed since the last run; how many files. A run repeated after a failure neither loses nor doubles rows."""
    seen = []

    def take(batch: DataFrame, lot: int) -> None:
        listed = batch.collect()  # names, max_files at most
        if listed:
            _write_lot(spark, feed, sorted(tuple(r) for r in listed), lot)
            seen.append(len(listed))

    listing = (
        spark.readStream.format("binaryFile").schema(_LISTED)  # the content is never asked for
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", feed.max_files)
        .load(feed.landing).select("path", F.col("_metadata.file_path").alias("arquivo"), F.col("length").alias("tamanho"))
    )
    query = listing.writeStream.foreachBatch(take).option("checkpointLocation", f"{feed.bronze}/controle").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(seen)


def _write_lot(spark: SparkSession, feed: Feed, listed: list[tuple], lot: int) -> None:
    wide = scan_groups(spark, [path for path, *_ in listed], feed.landing, feed.folders)
    target = f"{feed.bronze}/linhas/{LOT}={lot}"
    files.rescue(wide, feed.declared, keep=AUDIT).write.mode("overwrite").parquet(target)
    rows = spark.read.parquet(target)
    counted = rows.groupBy("_arquivo_origem").agg(F.count(F.lit(1)).alias("linhas"), F.count("_rescued_data").alias("resgatadas"))
    known = literal_table(spark, [(arquivo, tamanho) for _, arquivo, tamanho in listed], "arquivo string, tamanho bigint")
    at = {name: F.regexp_extract("arquivo", f"/{name}=([^/]*)/", 1).cast(kind).alias(name) for name, kind in feed.folders.items()}
    entry = known.join(counted, known.arquivo == counted._arquivo_origem, "left").select(
        "arquivo", "tamanho", *at.values(), F.coalesce("linhas", F.lit(0)).alias("linhas"), F.coalesce("resgatadas", F.lit(0)).alias("resgatadas"),
        F.current_timestamp().alias("ingerido_em"))
    if feed.checks:
        measured = expect_report(rows if feed.typed is None else feed.typed(rows), feed.checks)
        _appear(spark, measured.withColumn("medido_em", F.current_timestamp()), feed, "qualidade", lot)
    _appear(spark, entry, feed, "livro", lot)  # this entry is what makes the lot visible


def _appear(spark: SparkSession, df: DataFrame, feed: Feed, book: str, lot: int) -> None:
    """A few rows about a lot, there in one step; what an unfinished run left is replaced."""
    staged, place = f"{feed.bronze}/_{book}_{lot}", f"{feed.bronze}/{book}/{LOT}={lot}"
    df.coalesce(1).write.mode("overwrite").parquet(staged)
    store.remove(spark, place)
    store.move(spark, staged, place)


def quality_history(spark: SparkSession, feed: Feed) -> DataFrame:
    """(_lote, expectativa, linhas, violacoes, medido_em): what the checks found in every lot of the ledger."""
    schema = f"expectativa string, linhas bigint, violacoes bigint, medido_em timestamp, {LOT} int"
    if not store.exists(spark, f"{feed.bronze}/qualidade"):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", f"{feed.bronze}/qualidade").parquet(f"{feed.bronze}/qualidade")
    return found.where(F.col(LOT) <= last_lot(spark, feed))


def ledger(spark: SparkSession, feed: Feed) -> DataFrame:
    """(arquivo, tamanho, folder columns, linhas, resgatadas, ingerido_em, _lote): one row for each file that landed."""
    keys = ", ".join(f"`{n}` {k}, " for n, k in feed.folders.items()).replace(", ,", ",")
    schema = f"arquivo string, tamanho bigint, {keys}linhas bigint, resgatadas bigint, ingerido_em timestamp, {LOT} int"
    if not store.exists(spark, f"{feed.bronze}/livro"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{feed.bronze}/livro").parquet(f"{feed.bronze}/livro")


def last_lot(spark: SparkSession, feed: Feed) -> int:
    """The newest lot of the ledger; -1 while there is none."""
    return max((int(name.partition("=")[2]) for name in store.children(spark, f"{feed.bronze}/livro") if name.startswith(f"{LOT}=")), default=-1)


def rows(spark: SparkSession, feed: Feed, after: int = -1) -> DataFrame:
    """The rows of the ledger's lots that come ``after`` a lot: declared columns as text, rescue column, provenance."""
    names = [f.name for f in feed.declared]
    schema = T.StructType([*feed.declared.fields, T.StructField("_rescued_data", T.StringType()), T.StructField(AUDIT[0], T.StringType()),
                           T.StructField(AUDIT[1], T.TimestampType()), T.StructField(LOT, T.IntegerType())])
    newest = last_lot(spark, feed)
    if newest < 0:
        return spark.createDataFrame([], T.StructType(schema.fields[:-1]))
    found = spark.read.schema(schema).option("basePath", f"{feed.bronze}/linhas").parquet(f"{feed.bronze}/linhas")
    # Lots are numbered in order and repeated until they succeed: only those after the last entry may be unfinished.
    return found.where((F.col(LOT) > after) & (F.col(LOT) <= newest)).select(*names, *AUDIT, "_rescued_data")


def added(spark: SparkSession, feed: Feed, since) -> int:
    """Rows that landed at ``since`` or later, from the ledger alone."""
    return ledger(spark, feed).where(F.col("ingerido_em") >= F.lit(since)).agg(F.coalesce(F.sum("linhas"), F.lit(0))).first()[0]
