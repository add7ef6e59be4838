"""Parquet tables that can be written again after a failure without doubling rows."""
from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import TABLES

R = TypeVar("R")


def retry(action: Callable[[], R], retryable: Callable[[Exception], bool] = lambda e: True, attempts: int = 5,
          base_s: float = 0.8, sleep: Callable[[float], None] = time.sleep) -> R:
    """Run an action, waiting a little longer after every retryable failure."""
    for n in range(1, attempts + 1):
        try:
            return action()
        except Exception as e:  # noqa: BLE001 - the caller decides what is retryable
            if n == attempts or not retryable(e):
                raise
            sleep(base_s * n)
    raise ValueError("attempts must be at least 1")


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def create_tables(spark: SparkSession, root: str) -> list[str]:
    for name, schema in TABLES.items():
        create_if_absent(spark, f"{root}/{name}", schema)
    return list(TABLES)


def exists(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)


def write_if_empty(df: DataFrame, path: str) -> bool:
    """First fill of a table; a table that already has rows is left alone."""
    if exists(df.sparkSession, path) and not df.sparkSession.read.schema(df.schema).parquet(path).isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions (days) that occur in the rows.

    Rows of a day may sit in any number of files; nothing is gathered into one task per day.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """Catalog table bucketed and sorted by its key, so that joins of such tables need no shuffle."""
    w = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (w.option("path", path) if path else w).saveAsTable(table)


def append_batch(df: DataFrame, path: str, batch_id: int, app: str = "app") -> None:
    """Append of one micro-batch. A repeated batch replaces its own rows, so a replay adds nothing."""
    (
        df.withColumns({"app_id": F.lit(app), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("app_id", "batch_id").parquet(path)
    )


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Full state after a micro-batch. Readers take the newest complete version."""
    df.write.mode("overwrite").parquet(f"{path}/v={version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    dirs = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("v=")]
    return sorted(int(d.getName()[2:]) for d in dirs if fs.exists(jvm.Path(d, "_SUCCESS")))


def read_version(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Newest complete version, or the newest one before a batch (what a replay must start from)."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={known[-1]}")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest versions of a state table; a replay needs the one before the last."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for v in versions(spark, path)[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={v}"), True)


def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)
