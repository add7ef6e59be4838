"""Fitting rows to a schema, and checks on columns."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return df


def align_to_schema(df: DataFrame, schema: T.StructType, aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Exactly the columns of the schema: cast, renamed from an old name, or null where unknown.

    Where both the present and the old name exist, the first non-null one counts.
    """
    aliases = aliases or {}
    out = []
    for f in schema.fields:
        found = [c for c in (f.name, *aliases.get(f.name, ())) if c in df.columns]
        cast = [
            F.col(c).cast("string").try_cast(f.dataType) if df.schema[c].dataType == T.StringType() else F.col(c).cast(f.dataType)
            for c in found
        ]
        value = F.coalesce(*cast) if len(cast) > 1 else cast[0] if cast else F.lit(None).cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


def add_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame plus any schema column it lacks, as null."""
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in df.columns]
    return df.select("*", *extra)


def strip_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns if c in df.columns})


def null_share(df: DataFrame, column: str) -> DataFrame:
    """One row: share of nulls in a column."""
    return df.agg(F.avg(F.col(column).isNull().cast("int")).alias("null_share"))


def backfill(df: DataFrame, mapping: DataFrame, key: str, column: str, min_null_share: float = 0.5) -> DataFrame:
    """Fill nulls of a column from a mapping, but only when at least that share is missing."""
    share = null_share(df, column).scalar()
    known = mapping.select(key, F.col(column).alias("_known"))
    filled = F.when(share >= min_null_share, F.coalesce(F.col(column), F.col("_known"))).otherwise(F.col(column))
    return df.join(known, key, "left").withColumn(column, filled).select(*df.columns)


def first_usable(*sources: Callable[[], DataFrame]) -> DataFrame:
    """The first source that yields a row; the last one when none does."""
    last = None
    for make in sources:
        last = make()
        if not last.isEmpty():
            return last
    if last is None:
        raise ValueError("no source given")
    return last
