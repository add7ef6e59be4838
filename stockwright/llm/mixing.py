"""Mixing sources to target weights with Pfair scheduling.

Each source is dealt into blocks of rows. Time runs in slots of one block. With weight w, block j of a source is released
at slot floor(j / w) and due by slot ceil((j + 1) / w); in every slot the released block with the earliest deadline runs.
While no source has run out, each is always less than one block away from its share.

The schedule is made for the whole run, from the exact weights: they are taken as whole numbers with one denominator, so
releases and deadlines have no rounding. One task makes it, slot by slot; it holds one block per source at a time and
writes (source, block, slot) as a table, a row per block, which is joined to the rows. Sorting blocks by deadline alone would not do:
a heavy source would run far ahead of many light ones that are due together. When a source has run out its slots stay
empty, and every other source still keeps within a block of its share. Nothing is dropped or repeated.

A source is dealt in a fixed random order: rows fall into buckets of a few thousand by the hash of the key, are counted
per bucket and numbered inside it, so a source that holds a third of all rows is numbered by many tasks.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .tables import held, partitions, table

BLOCK_ROWS = 16
PERIOD = 4096
BUCKET_ROWS = 4096
ALPHA = 0.5  # target weight: rows of the source to this power
SEED = 7
FLUSH = 100_000  # blocks in a batch of the schedule


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots of a period per source: proportional, at least one, the rest by largest remainder."""
    total = sum(weights.values())
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: period - sum(out.values())]:
        out[s] += 1
    return out


def whole(weights: dict[str, float]) -> dict[str, int]:
    """The same weights as whole numbers, exactly."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * unit) for s, w in exact.items()}


def slots(weights: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of all blocks: of the released blocks the one with the earliest deadline runs."""
    total = sum(weights.values())
    waiting = [(0, s, 0) for s in sorted(blocks) if blocks[s]]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[s]), s, j))
        _, s, j = heapq.heappop(ready)
        yield s, j, slot
        slot += 1
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, ((j + 1) * total // weights[s], s, j + 1))


def schedule(share: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) for one period of whole shares."""
    return list(slots(share, share))


def schedule_table(spark: SparkSession, weights: dict[str, float], blocks: dict[str, int]) -> DataFrame:
    """(mix_source, mix_block, mix_slot) of all blocks, made by one task."""
    exact = whole(weights)

    def make(batches):
        names = ["mix_source", "mix_block", "mix_slot"]
        for _ in batches:
            out = []
            for row in slots(exact, blocks):
                out.append(row)
                if len(out) == FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    return spark.range(0, 1, 1, 1).mapInArrow(make, "mix_source string, mix_block bigint, mix_slot bigint")


def targets(counts: dict[str, int], alpha: float = ALPHA) -> dict[str, float]:
    return {s: float(n) ** alpha for s, n in counts.items()}


RESULTS = ("mix_source", "mix_block", "mix_slot", "mix_row")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, key: str = "doc_id", source: str = "source",
        block_rows: int = BLOCK_ROWS, seed: int = SEED, max_sources: int = 10_000) -> DataFrame:
    """All rows and columns with mix_source, mix_block (number in its source), mix_slot and mix_row (place in its block).

    A null source counts as the empty one. Without weights each source weighs its row count to the power ALPHA. Sources
    without a weight are an error. Repeated rows are dealt like others, in any order among each other. A column of the rows
    that has the name of a result gives way to it.
    """
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(docs.columns))]
    k, s = (names[docs.columns.index(c)] for c in (key, source))
    rows = docs.toDF(*names).withColumn("mix_source", F.coalesce(F.col(s).cast("string"), F.lit("")))
    found = rows.groupBy("mix_source").count().limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    counts = {r.mix_source: r["count"] for r in found}
    weights = weights or targets(counts)
    if missing := set(counts) - {n for n, w in weights.items() if w > 0}:
        raise ValueError(f"no weight for {sorted(missing)[:5]}")
    blocks = {n: -(-c // block_rows) for n, c in counts.items()}
    plan = held(schedule_table(spark, {n: weights[n] for n in counts}, blocks) if counts else spark.createDataFrame([], "mix_source string, mix_block bigint, mix_slot bigint"), "schedule")
    sizes = spark.createDataFrame([(n, -(-c // BUCKET_ROWS)) for n, c in counts.items()], "mix_source string, buckets bigint")

    order = F.xxhash64(F.lit(seed), F.col(k), F.col("mix_source"))
    rows = rows.join(F.broadcast(sizes), "mix_source").withColumn("mix_hash", order).withColumn("bucket", F.pmod(order, F.col("buckets")))
    before = Window.partitionBy("mix_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("mix_source", "bucket").agg(F.count("*").alias("n")).select("mix_source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("mix_source", "bucket").orderBy("mix_hash", k)) - 1
    placed = rows.withColumn("inside", inside).join(starts, ["mix_source", "bucket"]).withColumn("place", F.col("start") + F.col("inside"))
    placed = placed.withColumn("mix_block", F.expr(f"place div {block_rows}"))
    return placed.join(plan, ["mix_source", "mix_block"]).select(
        *[F.col(n).alias(c) for n, c in zip(names, docs.columns) if c.lower() not in RESULTS], "mix_source", "mix_block", "mix_slot",
        (F.col("place") % block_rows).cast("int").alias("mix_row"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", F.col("mix_source").alias("source"), "mix_block", "mix_slot", "mix_row")


def positioned(docs: DataFrame, name: str = "position") -> DataFrame:
    """The rows with their place, from 0, in the order of the files they were read from; rows from elsewhere are only in order."""
    try:
        rows = docs.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        files = rows.groupBy("__file").agg(F.count("*").alias("n"))
    except AnalysisException:
        return docs.withColumn(name, F.monotonically_increasing_id())
    before = Window.orderBy(F.length("__file"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(starts), "__file").select(*[F.col(c) for c in docs.columns], (F.col("__start") + F.col("__row")).alias(name))


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents in the order of the schedule: the files, one after the other, hold the slots in order."""
    order = ("mix_slot", "mix_row")
    names = [f"d{i}" for i in range(len(docs.columns))]
    key, source = (names[docs.columns.index(c)] for c in ("doc_id", "source"))
    mixed = mix(docs.toDF(*names), key=key, source=source)
    return mixed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select(*names).toDF(*docs.columns)
