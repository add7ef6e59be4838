"""Ordered scans per key that do not put a large key into one task.

A window partitioned by key sends every row of the key to one task. That is right for keys of up to ROWS_PER_TASK rows; the rows are
dealt by key once, over so many tasks that each gets about that number. The rows of larger keys, which are few, are range-partitioned by (key, order)
instead, so that a key spreads over neighbouring partitions ("slices"); each slice is scanned on its own and then gets the carry of
the slices before (or after) it. Only keys that cross a partition border need a carry, so there are fewer carry rows than
twice the partitions.

The rows are written down and counted per key first, and those of large keys once more with their slices, whose borders are sampled and
whose numbers are only valid for one run; that is the work done while the plan is built.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..workspace import cut

ROWS_PER_TASK = 500_000


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, sums: dict[str, str] | None = None,
                 carry_on: dict[str, str] | None = None, look_ahead: dict[str, str] | None = None) -> DataFrame:
    """Add ordered columns per key; a null key is a key like others.

    order names columns, ascending with nulls first, and must be total; derive a column for another order.

    sums:       {new: column}  sum of the column over all earlier rows, 0 for the first
    carry_on:   {new: column}  last non-null value up to and including the row
    look_ahead: {new: column}  first non-null value from the row on
    """
    if not all(isinstance(o, str) for o in order):
        raise ValueError("the order names columns; derive a column for another order")
    scan = list(keys), list(order), sums or {}, carry_on or {}, look_ahead or {}
    rows = cut(df)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, longest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if (longest or 0) <= ROWS_PER_TASK:
        return _scan(_dealt(rows, scan[0], total or 0), *scan)
    large = sizes.where(F.col("_n") > ROWS_PER_TASK).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    large = F.broadcast(df.sparkSession.createDataFrame(large.collect(), large.schema))  # at most one of each ROWS_PER_TASK rows
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(large[f"_k_{k}"]) for k in keys])
    small = _scan(_dealt(rows.join(large, same, "left_anti"), scan[0], total), *scan)
    return small.unionByName(_sliced_scan(rows.join(large, same, "left_semi"), *scan))


def _dealt(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """The rows by key over a number of tasks that grows with them; while there is a core for each, a window deals them itself.

    A number that is asked for is kept, where the usual one is cut down again to tasks of a size in bytes.
    """
    n = -(-total // ROWS_PER_TASK)
    return rows.repartition(n, *keys) if n > rows.sparkSession.sparkContext.defaultParallelism else rows


def _scan(df, part, order, sums, carry_on, look_ahead):
    w = W.partitionBy(*part).orderBy(*order)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    # Looking ahead is looking back in reverse order: a frame that ends at the last row would be
    # recomputed for every row.
    back = [F.desc_nulls_last(o) for o in order] if look_ahead else []
    ahead = W.partitionBy(*part).orderBy(*(back or order)).rowsBetween(W.unboundedPreceding, 0)
    new = {n: F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()}
    new |= {n: F.last(c, ignorenulls=True).over(upto) for n, c in carry_on.items()}
    new |= {n: F.last(c, ignorenulls=True).over(ahead) for n, c in look_ahead.items()}
    return df.withColumns(new)


def _sliced_scan(df, keys, order, sums, carry_on, look_ahead):
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The slice number is only valid for one run of the range partitioning, so it is written down.
    rows = cut(df.repartitionByRange(n, *keys, *order).withColumn("_slice", F.spark_partition_id()))
    local = _scan(rows, keys + ["_slice"], order, sums, carry_on, look_ahead)

    # One row per (key, slice); the rank inside a slice is by the same total order.
    rank = F.struct(*[F.col(o).alias(f"r{i}") for i, o in enumerate(order)])
    ends = [F.sum(c).alias(f"sum_{n_}") for n_, c in sums.items()]
    ends += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(f"end_{n_}") for n_, c in carry_on.items()]
    ends += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(f"end_{n_}") for n_, c in look_ahead.items()]
    slices = rows.groupBy(*keys, "_slice").agg(*ends)
    w = W.partitionBy(*keys).orderBy("_slice")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy(*keys).orderBy(F.desc("_slice")).rowsBetween(W.unboundedPreceding, -1)
    carry = {f"_c_{x}": F.coalesce(F.sum(f"sum_{x}").over(before), F.lit(0)) for x in sums}
    carry |= {f"_c_{x}": F.last(f"end_{x}", ignorenulls=True).over(before) for x in carry_on}
    carry |= {f"_c_{x}": F.last(f"end_{x}", ignorenulls=True).over(after) for x in look_ahead}
    size = W.partitionBy(*keys)
    borders = (
        slices.withColumns(carry).withColumn("_n", F.count(F.lit(1)).over(size)).where("_n > 1")
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_k_slice"), *carry)
    )
    on = reduce(lambda a, b: a & b, [local[k].eqNullSafe(borders[f"_k_{k}"]) for k in keys], local["_slice"] == borders["_k_slice"])
    joined = local.join(borders, on, "left")
    fixed = {x: F.col(x) + F.coalesce(F.col(f"_c_{x}"), F.lit(0)) for x in sums}
    fixed |= {x: F.coalesce(F.col(x), F.col(f"_c_{x}")) for x in (*carry_on, *look_ahead)}
    return joined.withColumns(fixed).select(*df.columns, *fixed)

