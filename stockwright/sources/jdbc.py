"""Relational databases through JDBC. The driver jar comes with the cluster."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import keep_newer
from ..workspace import cut
from .sinks import retry


@dataclass(frozen=True)
class Database:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    options: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver, **self.options}


def select_query(table: str, columns: Sequence[str], where: str | None = None) -> str:
    return f"SELECT {', '.join(columns)} FROM {table}" + (f" WHERE {where}" if where else "")


def read(spark: SparkSession, db: Database, table: str, columns: Sequence[str], where: str | None = None,
         partition: tuple[str, str, str, int] | None = None) -> DataFrame:
    """Columns and filter run in the database. partition = (column, lower, upper, number) reads in parallel."""
    r = spark.read.format("jdbc").options(**db.settings())
    query = select_query(table, columns, where)
    if partition is None:
        return retry(lambda: r.option("query", query).load())
    column, low, high, n = partition
    r = r.option("dbtable", f"({query}) q").option("partitionColumn", column)
    return retry(lambda: r.option("lowerBound", low).option("upperBound", high).option("numPartitions", n).load())


def read_optional(spark: SparkSession, db: Database, table: str, needed: Sequence[str]) -> DataFrame | None:
    """The table, or None when it cannot be read or lacks a needed column (then use another source)."""
    try:
        df = spark.read.format("jdbc").options(**db.settings()).option("dbtable", table).load()
    except Exception:  # noqa: BLE001 - the driver raises vendor-specific errors
        return None
    return df.select(*needed) if set(needed) <= set(df.columns) else None


def append(df: DataFrame, db: Database, table: str) -> None:
    w = df.write.format("jdbc").options(**db.settings()).option("dbtable", table).option("stringtype", "unspecified")
    retry(lambda: w.mode("append").save())


def refresh(df: DataFrame, db: Database, table: str) -> None:
    """Replace all rows and keep the table with its grants and indexes."""
    w = df.write.format("jdbc").options(**db.settings()).option("dbtable", table).option("truncate", True)
    retry(lambda: w.mode("overwrite").save())


def upsert_newer(df: DataFrame, db: Database, table: str, keys: Sequence[str], ts_col: str) -> None:
    """Upsert that keeps the greater time. The merged rows are written to the shared folder before
    the table is refreshed, because the table is also their source."""
    current = read(df.sparkSession, db, table, df.columns)
    refresh(cut(keep_newer(current, df, keys, ts_col)), db, table)
