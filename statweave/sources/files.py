"""Scans and sinks for landed files: everything is text until a rule types it."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake(name: str) -> str:
    """'Município - Código' -> 'municipio_codigo'."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return "_".join(re.findall(r"[0-9a-z]+", plain.lower()))


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake, df.columns))


def text_schema(columns: Iterable[str], **typed: str) -> T.StructType:
    """All-text schema; ``typed`` adds columns with another type (folder columns)."""
    kinds = {**dict.fromkeys(columns, "string"), **typed}
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))


def scan_partitioned(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet in ``key=value`` folders: the folder columns become columns of the table."""
    reader = spark.read.option("basePath", path)
    return (reader if schema is None else reader.schema(schema)).parquet(path)


def scan_ignoring_folders(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet whose folder names repeat columns of the files: the file values win."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader if schema is None else reader.schema(schema)).parquet(path)


def folder_clash(spark: SparkSession, path: str) -> list[str]:
    """Columns present both in the folder names and in the files.

    Spark would silently return the folder value for them; scan such a table with
    ``scan_ignoring_folders``.
    """
    inside = set(spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path).columns)
    files = spark.read.parquet(path).inputFiles()  # names only; every file and depth counts
    folders = dict.fromkeys(k for f in files for k in re.findall(r"/([^/=]+)=[^/]*(?=/)", f[f.index(path.rstrip("/")) + len(path.rstrip("/")):]))
    return [name for name in folders if name in inside]


def with_audit(df: DataFrame) -> DataFrame:
    """Source file and ingestion time beside every row."""
    return df.withColumns({"_arquivo_origem": F.col("_metadata.file_path"), "_ingerido_em": F.current_timestamp()})


def rescue(wide: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Fit rows to a declared schema; whatever does not fit goes to ``_rescued_data`` as JSON.

    Rescued are undeclared columns and texts that do not convert to the declared type.
    Rows that fit entirely have NULL there, so a count of it is an alarm. ``keep`` names
    columns added on the way, which are neither declared nor rescued.
    """
    declared = {f.name: f.dataType for f in schema}
    fitted, spilled = [], []
    for name, kind in declared.items():
        if name not in wide.columns:
            fitted.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name).try_cast(kind)
        fitted.append(value.alias(name))
        if wide.schema[name].dataType != kind:
            spilled.append(F.when(value.isNull(), F.col(name)).alias(name))
    spilled += [F.col(name) for name in wide.columns if name not in declared and name not in keep]
    fitted += [F.col(name) for name in keep]
    if not spilled:
        return wide.select(*fitted, F.lit(None).cast("string").alias("_rescued_data"))
    something = F.coalesce(*[c.cast("string") for c in spilled]).isNotNull()
    return wide.select(*fitted, F.when(something, F.to_json(F.struct(*spilled))).alias("_rescued_data"))


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files whose columns have the same types, and the columns of each group.

    Footers are merged by Spark jobs; only where types differ the files are halved and
    looked at again, and groups that fit together are joined.
    """
    try:
        found = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths).schema
        return [(found, list(paths))]
    except Exception as problem:  # Spark hands this one on as an error of the JVM
        if len(paths) == 1 or not re.search("CANNOT_MERGE|[Ff]ailed to merge|[Ff]ailed merging", str(problem)):
            raise
    groups: list[tuple[T.StructType, list[str]]] = []
    for half in (paths[:len(paths) // 2], paths[len(paths) // 2:]):
        for schema, some in schema_groups(spark, half):
            for k, (known, others) in enumerate(groups):
                kinds = {f.name: f.dataType for f in known}
                if all(kinds.get(f.name, f.dataType) == f.dataType for f in schema):
                    wider = T.StructType([*known.fields, *(f for f in schema if f.name not in kinds)])
                    groups[k] = (wider, others + some)
                    break
            else:
                groups.append((schema, some))
    return groups


def as_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as text, nested ones as JSON; ``keep`` stays as it is."""
    out = []
    for f in df.schema:
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        text = F.to_json(F.col(f"`{f.name}`")) if nested else F.col(f"`{f.name}`").cast("string")
        out.append(F.col(f"`{f.name}`") if f.name in keep else text.alias(f.name))
    return df.select(*out)


def scan_rescued(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All Parquet files under a path, fitted to a declared schema; one column may have other types in other files."""
    paths = [unquote(name) for name in spark.read.option("recursiveFileLookup", "true").parquet(path).inputFiles()]  # names only
    groups = schema_groups(spark, paths)
    read = lambda kinds, some: spark.read.schema(kinds).option("recursiveFileLookup", "true").parquet(*some)
    if len(groups) == 1:
        return rescue(read(*groups[0]), schema)
    return rescue(union_by_name(*(as_text(read(*group)) for group in groups)), schema)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column missing on one side is NULL there."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first


def scan_delimited(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";", encoding: str = "UTF-8"
) -> DataFrame:
    """Headered delimited text, every column text, found by its name in the header.

    The order of columns in the file does not matter and further columns are left out; a
    missing one is an error. Files of one call have the same header.
    """
    wide = spark.read.csv(path, header=True, sep=sep, encoding=encoding, inferSchema=False)
    if missing := [name for name in columns if name not in wide.columns]:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(wide.columns)}")
    return wide.select(*(F.col(f"`{name}`") for name in columns))


def write_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8") -> str:
    df.write.mode("overwrite").csv(path, header=True, sep=sep, encoding=encoding)
    return path


def region_filter(df: DataFrame, column: str, members: Iterable) -> DataFrame:
    return df.where(F.trim(F.col(column)).isin([str(m) for m in members]))


def scan_prefix(df: DataFrame, column: str, prefix: str, columns: Sequence[str]) -> DataFrame:
    """A few columns of the rows whose code starts with a prefix."""
    return df.where(F.col(column).startswith(prefix)).select(*columns)


def fixed_width(lines: DataFrame, layout: Mapping[str, tuple[int, int]], value: str = "value") -> DataFrame:
    """Cut fields out of text lines by [start, end) offsets counted from 0, trimmed; a blank is NULL."""
    fields = {name: F.trim(F.substring(value, start + 1, end - start)) for name, (start, end) in layout.items()}
    return lines.select(*[F.nullif(field, F.lit("")).alias(name) for name, field in fields.items()])


def scan_fixed_width(spark: SparkSession, path: str, layout: Mapping[str, tuple[int, int]], encoding: str = "UTF-8") -> DataFrame:
    """Fixed-width lines in the given encoding: offsets count characters, not bytes."""
    line = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return fixed_width(spark.read.text(path).select(line.alias("value")), layout)


def fixed_width_line(layout: Mapping[str, tuple[int, int]]) -> Column:
    """The inverse: one padded text line from the columns of a row. A value wider than its field is an error."""
    pieces, position = [], 0
    for name, (start, end) in sorted(layout.items(), key=lambda item: item[1]):
        if start > position:
            pieces.append(F.lit(" " * (start - position)))
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        wide = F.raise_error(F.concat(F.lit(f"value wider than {end - start} characters in field {name}: "), value))
        pieces.append(F.when(F.length(value) > end - start, wide).otherwise(F.rpad(value, end - start, " ")))
        position = end
    return F.concat(*pieces)


def dim_from_filenames(spark: SparkSession, pattern: str, prefix: str, pad: Mapping[str, int] | None = None) -> DataFrame:
    """Dictionaries, one file or folder per domain: (dominio, codigo, descricao).

    The domain is the part of the name after ``prefix``. ``pad`` gives code lengths for
    domains whose leading zeros were lost; a longer code stays as it is.
    """
    domain = F.regexp_extract(F.col("_metadata.file_path"), rf"{prefix}([^/]*)\.csv", 1)
    rows = spark.read.csv(pattern, header=True, inferSchema=False).select("codigo", "descricao", domain.alias("dominio"))
    code = F.col("codigo")
    for name, width in (pad or {}).items():
        short = (F.col("dominio") == name) & (F.length("codigo") < width)
        code = F.when(short, F.lpad("codigo", width, "0")).otherwise(code)
    return rows.select("dominio", code.alias("codigo"), "descricao")


def dim_from_json_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A file holding one JSON object, one row per entry; the key is an integer code."""
    entries = F.explode(F.from_json("value", "map<string,string>")).alias("_k", "_v")
    return (
        spark.read.text(path, wholetext=True)
        .select(entries)
        .select(F.col("_k").try_cast("int").alias(key), F.col("_v").alias(value))
    )


def dim_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV in the declared types, columns found by name; what does not convert is NULL."""
    fields = T.StructType.fromDDL(schema).fields
    wide = scan_delimited(spark, path, [f.name for f in fields], sep=",")
    return wide.select(*(F.trim(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in fields))


def query_files(spark: SparkSession, path: str, sql: str) -> DataFrame:
    """SQL straight on a Parquet folder; ``{files}`` in the text stands for it."""
    return spark.sql(sql.replace("{files}", f"parquet.`{path}`"))


def write_partitioned(df: DataFrame, path: str, *keys: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Parquet folders per key; only the folders present in ``df`` are replaced.

    The rebalance hint brings rows of a folder together so that no task writes a sliver
    into every folder, and still lets Spark split a folder that holds much of the data.
    ``finish`` makes the rows of the files, row by row and with the same keys: it sees them
    when they are dealt and sorted, so that only the columns it needs are moved.
    """
    dealt = df.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    (
        (dealt if finish is None else finish(dealt))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach the meaning of each column; it is saved with the table."""
    for name, text in comments.items():
        df = df.withMetadata(name, {"comment": text})
    return df
