"""Kafka and JSON messages."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import compound_key
from ..functions.times import parse_instant
from ..schemas import wire


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str = "earliest",
                 fail_on_loss: bool = False, max_records: int | None = None) -> DataFrame:
    r = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", start).option("failOnDataLoss", str(fail_on_loss).lower())
    )
    return (r.option("maxOffsetsPerTrigger", max_records) if max_records else r).load()


def kafka_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
    )


def decode(df: DataFrame, schema: T.StructType, not_null: Sequence[str] = (), value: str = "value",
           keep: Sequence[str] = ()) -> DataFrame:
    """JSON messages to typed rows. Times arrive as text; unreadable fields become null, and rows
    without the required fields are left out."""
    # As rows of a generator the fields are parsed once; plain fields of a parsed struct would be
    # parsed again for every filter that is pushed below them.
    body = F.from_json(F.col(value).cast("string"), wire(schema))
    parsed = df.select(*keep, F.inline(F.array(body)))
    typed = []
    for f in schema.fields:
        raw = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            raw = parse_instant(raw)
        elif isinstance(f.dataType, T.DateType):
            raw = F.substring(raw, 1, 10).try_cast("date")
        typed.append(raw.alias(f.name))
    rows = parsed.select(*keep, *typed)
    for c in not_null:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def encode(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None,
           rename: dict[str, str] | None = None) -> DataFrame:
    """Rows to (key, value) messages; no keys means a null key (append-only topics)."""
    rename = rename or {}
    body = F.struct(*[F.col(c).alias(rename.get(c, c)) for c in columns or df.columns])
    key = compound_key(*keys) if keys else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(body).alias("value"))


def with_shelf(df: DataFrame, shelf: str = "shelf_id", fallback: str = "item_id") -> DataFrame:
    """The shelf of an event; older producers only send the item."""
    return df.withColumn(shelf, F.coalesce(F.col(shelf), F.col(fallback)))


def publish(df: DataFrame, servers: str, topic: str) -> None:
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
