"""One row per key: latest revision, event de-duplication, touched keys."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    """Row with the greatest order_by per key, null order last.

    An aggregate instead of a row number: each task sends at most one row per key into the
    shuffle, so a key that holds much of the table costs no more than any other. Ties are
    settled by tie_break, by default by all remaining columns, so that the result is unique.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [c for c in df.columns if c not in keys]
    ties = rest if tie_break is None else list(tie_break)
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order + [F.col(c) for c in ties])])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_slice(df: DataFrame, ts_col: str) -> DataFrame:
    """All rows that carry the latest value of a column."""
    return df.where(F.col(ts_col) == df.agg(F.max(ts_col)).scalar())


def dedupe_events(df: DataFrame, id_col: str, fallback_cols: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row per event id; rows without a usable id are the same event if the fallback columns agree."""
    usable = F.when(F.trim(F.col(id_col).cast("string")) != "", F.col(id_col).cast("string"))
    by_value = F.to_json(F.struct(*[F.col(c) for c in fallback_cols]), {"ignoreNullFields": "false"})
    keyed = df.withColumn("_key", F.coalesce(F.concat(F.lit("id:"), usable), F.concat(F.lit("v:"), by_value)))
    return latest_per_key(keyed, ["_key"], order_by).drop("_key")


def touched(state: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the state whose key occurs in keys_df."""
    return state.join(keys_df.select(*keys).distinct(), list(keys), "left_semi")
