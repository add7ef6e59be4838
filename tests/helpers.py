"""Small frames and readable results for the tests."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

NOW = "1998-06-01 12:00:00"
DAY = "1998-06-01"


def ts(v=NOW):
    return F.lit(v).cast("timestamp")


def day(v=DAY):
    return F.lit(v).cast("date")


def frame(spark, ddl: str, *rows) -> DataFrame:
    """Rows in a frame; times and dates are given as text."""
    parts = [c.strip().split(None, 1) for c in ddl.split(",")]
    plain = ", ".join(f"{n} {'string' if t in ('timestamp', 'date') else t}" for n, t in parts)
    df = spark.createDataFrame(list(rows), plain)
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in parts])


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    got = df.select(*cols) if cols else df
    return sorted((tuple(str(v) if hasattr(v, "strftime") else v for v in r) for r in got.collect()), key=str)
