"""Splitting quantities: lots over demands, transfers, batches, shares of a total."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .ordered import ordered_scan


def allocate(demand: DataFrame, supply: DataFrame, group: str, demand_order: Sequence[str],
             supply_order: Sequence[str], need: str, qty: str, per_demand: bool = False,
             unserved: bool = False) -> DataFrame:
    """Serve demands from lots of the same group, both in order; returns both sides' columns and take.

    Needs and lots are laid end to end on one line per group. Each piece between two borders of
    the merged line belongs to one demand and one lot, so the result comes from one ordered pass
    over demands plus lots and never pairs every demand with every lot.

    With unserved, what no lot can serve comes out too, as one row per demand without a lot.
    With per_demand each demand draws on all lots as if it were alone, so by definition there are rows for
    each demand and every lot that it reaches.
    The two sides must not share a column name other than the group.
    """
    if clash := (set(demand.columns) & set(supply.columns)) - {group}:
        raise ValueError(f"both sides have {sorted(clash)}")
    if per_demand and unserved:
        raise ValueError("unserved rows are only known when demands share the lots")
    stock, wanted = supply.where(F.col(qty) > 0), demand.where(F.col(need) > 0)
    lots = ordered_scan(stock, [group], supply_order, sums={"_s0": qty})
    lots = lots.withColumn("_s1", F.col("_s0") + F.col(qty))
    if per_demand:
        return _alone(wanted, lots, group, need, qty)
    wanted = ordered_scan(wanted, [group], demand_order, sums={"_d0": need})
    wanted = wanted.withColumn("_d1", F.col("_d0") + F.col(need))
    d_side = wanted.select(group, F.col("_d1").alias("_pos"), F.lit(0).alias("_side"),
                           F.struct(*[c for c in wanted.columns if c != group]).alias("_d"))
    s_side = lots.select(group, F.col("_s1").alias("_pos"), F.lit(1).alias("_side"),
                         F.struct(*[c for c in lots.columns if c != group]).alias("_s"))
    line = ordered_scan(
        d_side.unionByName(s_side, allowMissingColumns=True), [group], ["_pos", "_side"],
        look_ahead={"_nd": "_d", "_ns": "_s"}, carry_on={"_served": "_s"} if unserved else None,
    )
    start = F.greatest(F.col("_nd._d0"), F.col("_ns._s0"))
    pieces = line.where(F.col("_nd").isNotNull())
    if unserved:
        # Past the last lot: the demand less the end of the supply.
        start = F.when(F.col("_ns").isNotNull(), start).otherwise(
            F.greatest(F.col("_nd._d0"), F.coalesce(F.col("_served._s1"), F.lit(0)))
        )
    else:
        pieces = pieces.where(F.col("_ns").isNotNull())
    return pieces.withColumn("take", F.col("_pos") - start).where("take > 0").select(
        group,
        *[F.col("_nd")[c].alias(c) for c in demand.columns if c != group],
        *[F.col("_ns")[c].alias(c) for c in supply.columns if c != group],
        "take",
    )


def _alone(wanted, lots, group, need, qty):
    """Every demand takes a prefix of the lots. Lots fall into cells of the line as wide as the
    group's mean lot; a demand visits the cells it covers, so rows met stay close to rows produced
    and a large group spreads over its cells."""
    width = lots.groupBy(group).agg(
        F.ceil(F.sum(qty) / F.count(F.lit(1))).alias("_w"), F.max("_s1").alias("_total")
    )
    cells = lots.join(width.select(group, "_w"), group).withColumn("_cell", F.floor(F.col("_s0") / F.col("_w")))
    reach = F.floor((F.least(F.col(need), F.col("_total")) - 1) / F.col("_w"))
    visits = wanted.join(width, group).withColumn("_cell", F.explode(F.sequence(F.lit(0).cast("bigint"), reach)))
    hit = visits.drop("_w", "_total").join(cells.drop("_w"), [group, "_cell"]).where(F.col("_s0") < F.col(need))
    return hit.withColumn("take", F.least(F.col(qty), F.col(need) - F.col("_s0"))).drop("_cell", "_s0", "_s1")


def shortage(demand: DataFrame, taken: DataFrame, keys: Sequence[str], need: str) -> DataFrame:
    """Per demand: wanted, served and missing quantity."""
    served = taken.groupBy(*keys).agg(F.sum("take").alias("served"))
    got = F.coalesce(F.col("served"), F.lit(0))
    return demand.join(served, list(keys), "left").select(
        *keys, F.col(need).cast("bigint").alias("wanted"), got.cast("bigint").alias("served"),
        (F.col(need) - got).cast("bigint").alias("missing"),
    )


def split_batches(df: DataFrame, qty: str, batch: str, index: str = "batch_no", out: str = "batch_qty") -> DataFrame:
    """Full batches and one remainder; the split of a row is as long as its number of batches."""
    n = F.ceil(F.col(qty) / F.col(batch)).cast("int")
    usable = df.where((F.col(qty) > 0) & (F.col(batch) > 0))
    numbered = usable.withColumn(index, F.explode(F.sequence(F.lit(1), n)))
    return numbered.withColumn(out, F.least(F.col(batch), F.col(qty) - F.col(batch) * (F.col(index) - 1)))


def apportion(df: DataFrame, group: Sequence[str], total: str, weight: str, order: str, out: str = "share") -> DataFrame:
    """Largest-remainder split of a total over the weighted slots of a group (parts of a day: few).

    The leftover units go to the largest fractions, earlier slot first. Without any weight the
    total is split evenly.
    """
    w = W.partitionBy(*group)
    weights = F.sum(weight).over(w)
    slots = F.count(F.lit(1)).over(w)
    even = F.when(weights > 0, F.col(weight)).otherwise(F.lit(1))
    base = F.when(weights > 0, weights).otherwise(slots)
    # Integer arithmetic, so that equal fractions tie exactly.
    scaled = F.greatest(F.col(total), F.lit(0)).cast("bigint") * even.cast("bigint")
    part = df.withColumns({"_base": base.cast("bigint"), "_scaled": scaled})
    part = part.withColumn("_rest", F.pmod("_scaled", "_base"))
    part = part.withColumn("_floor", ((F.col("_scaled") - F.col("_rest")) / F.col("_base")).cast("bigint"))
    left = F.greatest(F.col(total), F.lit(0)) - F.sum("_floor").over(w)
    place = F.row_number().over(w.orderBy(F.desc("_rest"), F.col(order)))
    extra = F.when(place <= left, 1).otherwise(0)
    return part.withColumn(out, F.col("_floor") + extra).drop("_base", "_scaled", "_rest", "_floor")
