"""Parquet and CSV tables, streaming folders, snapshots of changelogs."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.align import require_columns
from ..operators.latest import latest_per_key


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | Sequence[Column] | None = None, limit: int | None = None) -> DataFrame:
    """Parquet scan; columns and filters reach the files. limit is for displays only."""
    df = spark.read.parquet(path)
    if where is not None:
        for p in [where] if isinstance(where, Column) else where:
            df = df.where(p)
    if columns:
        df = require_columns(df, columns).select(*columns)
    return df if limit is None else df.limit(limit)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """CSV with a header and a declared schema; fields are matched to the header by name."""
    header = require_columns(spark.read.option("header", True).csv(path), required)
    typed = {f.name: f.dataType for f in schema.fields}
    return header.select(*[F.trim(F.col(c)).try_cast(typed[c]).alias(c) for c in header.columns if c in typed])


def read_checked(spark: SparkSession, path: str, schema: T.StructType, not_null: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of CSV files with a header. Nothing is dropped: each line is in one of the two.

    Good rows have the schema. Bad ones have it too (null where a value does not fit), with a reason and the line:
    "unreadable" where the line has more or fewer fields or a value that does not fit its type, "missing" where a required
    column is empty. The reason looks at all columns, whichever are selected later.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*schema.names, "_line"]])
    rows = spark.read.schema(text).option("header", True).option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    misfit = reduce(or_, [F.col(c).isNotNull() & v.isNull() for c, v in typed.items()], F.col("_line").isNotNull())
    missing = reduce(or_, [F.col(c).isNull() for c in not_null], F.lit(False))
    found = rows.select(*[v.alias(c) for c, v in typed.items()], F.when(misfit, "unreadable").when(missing, "missing").alias("reason"),
                        F.coalesce("_line", F.to_csv(F.struct(*schema.names))).alias("line"))
    return found.where("reason is null").select(*schema.names), found.where("reason is not null")


def read_evolved(spark: SparkSession, path: str, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """A table whose files are older and newer than some of its columns: the columns of the schema, by name.

    A column that a file lacks is null there, or has its default; a null stored in a newer file gets the default as well.
    The schema is given and not merged from the files, so no footer is read before the scan.
    """
    rows = spark.read.schema(schema).parquet(path)
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(schema[c].dataType)) for c, v in (defaults or {}).items()})


def in_partitions(table: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """Rows whose partition occurs among the wanted rows; folders of other partitions are not read.

    The wanted partitions are known only when the query runs (dynamic pruning), so a filter on a small table reaches the
    scan of a large one. by: the partition column, also in wanted.
    """
    return table.join(wanted.select(by).distinct(), by, "left_semi")


def stream_files(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
                 max_files: int | None = None) -> DataFrame:
    """Parquet folder as a stream, a bounded number of files per trigger."""
    r = spark.readStream.schema(schema)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def changelog_snapshot(log: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """A compacted topic read as a table: the last row per key, and none for keys last seen as deleted."""
    deleted = F.col("_deleted") if "_deleted" in log.columns else F.lit(False)
    latest = latest_per_key(log.withColumn("_gone", F.coalesce(deleted, F.lit(False))), keys, order_by)
    return latest.where(~F.col("_gone")).drop("_gone")


def incremental(df: DataFrame, ts_col: str, since: Column) -> tuple[DataFrame, DataFrame]:
    """Rows newer than the mark, and a one-row frame with the next mark."""
    rows = df.where(F.col(ts_col) > since)
    mark = rows.agg(F.coalesce(F.max(ts_col), since).alias("next_mark"))
    return rows, mark


def topic_name(table: str, pattern: str = r"config\.(.*)", replacement: str = r"\1") -> str:
    """Topic of a table, by a regular-expression rename that must match the whole name."""
    m = re.fullmatch(pattern, table)
    return m.expand(replacement) if m else table


def keyed_rows(df: DataFrame, key_fields: Sequence[str]) -> DataFrame:
    """Rows as messages whose key is built from value fields."""
    key = F.col(key_fields[0]).cast("string") if len(key_fields) == 1 else F.to_json(F.struct(*key_fields))
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
