"""Rows of named streams to topics, and changelogs to keyed tables."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.align import align_to_schema
from ..operators.merge import replace_rows
from ..sources.files import changelog_snapshot
from ..workspace import cut


def parse_mapping(text: str) -> dict[str, str]:
    """'stream=topic, ...' to a mapping; empty or malformed input is an error."""
    out = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        stream, eq, topic = (x.strip() for x in part.partition("="))
        if not (stream and eq and topic):
            raise ValueError(f"not a stream=topic pair: {part!r}")
        out[stream] = topic
    if not out:
        raise ValueError("no stream is mapped to a topic")
    return out


def route(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """(topic, key, value) of rows (stream, key, value); rows without a payload or a topic are left out."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    topic = F.try_element_at(pairs, F.col("stream"))
    rows = df.where(F.col("value").isNotNull() & (F.trim("value") != "")).select(topic.alias("topic"), "key", "value")
    return rows.where("topic is not null")


def mirror(table: DataFrame, log: DataFrame, keys: Sequence[str], order_by: Sequence[str],
           columns: Sequence[str] | None = None) -> DataFrame:
    """Keyed table after a changelog: last row per key, only the allowed columns.

    The last rows are written down, because the table needs their keys as well and the log is to be read once.
    """
    fresh = changelog_snapshot(log, keys, order_by)
    names = [*keys, *[c for c in columns or table.columns if c not in keys]]
    return replace_rows(table, cut(align_to_schema(fresh.select(*[c for c in fresh.columns if c in names]), table.schema)), keys)
