"""Small helpers shared by the operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import new_folder


ARROW_ROWS = "1000"  # rows in a batch for a Python worker, which then stays small whatever texts it gets


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: later steps read them instead of computing them again."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def field_names(df: DataFrame, *fields: str) -> str:
    """A schema text: the first column's own type, then the given fields."""
    return ", ".join([f"`{df.columns[0]}` {df.schema[0].dataType.simpleString()}", *fields])
