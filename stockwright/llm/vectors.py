"""Vectors as fixed-width binary rows, and blocks of queries against blocks of rows."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

ID, VECTOR = "vec_id", "embedding"


def usable(df: DataFrame, key: str = ID, vector: str = VECTOR, zero: bool = True) -> DataFrame:
    """(id, v, dim): one row per id, without vectors that are null or hold null or non-finite components.

    Rows that share an id count once, with the smallest vector; rows without an id take no part. zero=False leaves
    out vectors of length zero too.
    """
    x = F.col(vector)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    rows = df.where(F.col(key).isNotNull() & x.isNotNull() & ~F.coalesce(F.exists(x, bad), F.lit(False)))
    if not zero:
        rows = rows.where(F.exists(x, lambda c: c != 0))
    return rows.groupBy(F.col(key).cast("bigint").alias("id")).agg(F.min(x).alias("v")).withColumn("dim", F.size("v"))


def matrix(column: pa.Array, dim: int, kind) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), dim)


def sampled(df: DataFrame, size: int, seed: int, columns: tuple[str, ...] = ("id", "v")) -> list:
    """``size`` rows, those with the smallest hash of their id; the bound is the size of what the driver gets."""
    return df.select(*columns, F.xxhash64(F.lit(seed), "id").alias("h")).orderBy("h", "id").limit(size).collect()


def best(found: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows of each query, with their rank."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order, F.asc("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
