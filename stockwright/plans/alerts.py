"""Refill, reorder and near-expiry alerts, and the plans that follow from them."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import stock as S
from ..functions.ids import named_id
from ..functions.times import days_until, within_days
from ..operators.merge import exclude_recent
from .config import latest_policies

ALERT_KEY = ["event_type", "shelf_id", "location"]
ALERT_COLUMNS = ALERT_KEY + ["current_stock", "min_qty", "threshold_pct", "stock_pct", "suggested_qty"]


def resolve_policy(shelves: DataFrame, policies: DataFrame, by_category: bool = False) -> DataFrame:
    """Each shelf with its threshold_pct and min_qty: own policy, else the global one, else the defaults.

    by_category adds the levels between: subcategory, then category (shelves must carry both).
    """
    p = latest_policies(policies, ["shelf_id", "item_category", "item_subcategory"] if by_category else ["shelf_id"])
    values = ["threshold_pct", "min_qty"]
    none = lambda *cs: [F.col(c).isNull() for c in cs]

    def level(df, keys, tag, *empty):
        rows = p.where(F.col(keys[0]).isNotNull())
        for cond in none(*empty):
            rows = rows.where(cond)
        return df.join(rows.select(*keys, *[F.col(v).alias(f"_{tag}_{v}") for v in values]), keys, "left")

    out, tags = level(shelves, ["shelf_id"], "own"), ["own"]
    if by_category:
        out = level(out, ["item_subcategory"], "sub", "shelf_id")
        out = level(out, ["item_category"], "cat", "shelf_id", "item_subcategory")
        tags += ["sub", "cat"]
    rows = p.where("shelf_id is null")
    if by_category:
        rows = rows.where("item_category is null and item_subcategory is null")
    default = {"threshold_pct": S.DEFAULT_THRESHOLD_PCT, "min_qty": S.DEFAULT_MIN_QTY}
    # The global policy is one row: a scalar subquery, null when there is none.
    common = rows.agg(F.max_by(F.struct(*values), "updated_at").alias("common")).scalar()
    for v in values:
        out = out.withColumn(v, F.coalesce(*[F.col(f"_{t}_{v}") for t in tags], common[v], F.lit(default[v])))
    return out.drop(*[f"_{t}_{v}" for t in tags for v in values])


def shelf_levels(state: DataFrame, policies: DataFrame, capacity: DataFrame, target_pct: float = S.DEFAULT_TARGET_PCT) -> DataFrame:
    """State with policy, capacity, fill level and suggested refill quantity."""
    base = resolve_policy(state.select("shelf_id", "current_stock"), policies)
    joined = base.join(capacity.select("shelf_id", "maximum_stock"), "shelf_id", "left")
    return joined.withColumns({
        "stock_pct": S.stock_pct("current_stock", "maximum_stock"),
        "suggested_qty": S.suggested_qty("current_stock", "maximum_stock", "min_qty", target_pct),
    })


def refill_needed(levels: DataFrame) -> DataFrame:
    return levels.where(S.needs_refill("current_stock", "stock_pct", "threshold_pct", "min_qty"))


def soonest_expiry(lots: DataFrame, qty: str, today: Column, all_lots: bool = False) -> DataFrame:
    """Soonest expiry and quantity on lots per shelf.

    Empty and already expired lots are left out, because an expired one would hide a lot that is
    about to expire; all_lots keeps them.
    """
    rows = lots if all_lots else lots.where((F.col(qty) > 0) & (F.col("expiry_date") >= today))
    return rows.groupBy("shelf_id").agg(F.min("expiry_date").alias("min_expiry"), F.sum(qty).alias("qty_on_batches"))


def near_expiry(soonest: DataFrame, shelves: DataFrame, today: Column, days: int) -> DataFrame:
    return (
        soonest.join(shelves.select("shelf_id").distinct(), "shelf_id", "left_semi")
        .where(within_days("min_expiry", today, days))
        .withColumn("days_to_expiry", days_until("min_expiry", today))
    )


def _alert(df: DataFrame, event: str, location: str, **cols: Column) -> DataFrame:
    """Alert rows in the common shape; columns not given are typed nulls."""
    types = {"current_stock": "int", "min_qty": "int", "threshold_pct": "double", "stock_pct": "double", "suggested_qty": "int"}
    body = [cols.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()]
    return df.select(F.lit(event).alias("event_type"), "shelf_id", F.lit(location).alias("location"), *body)


def refill_alerts(levels: DataFrame) -> DataFrame:
    own = {c: F.col(c) for c in ("current_stock", "min_qty", "threshold_pct", "stock_pct", "suggested_qty")}
    return _alert(refill_needed(levels), "refill_request", "store", **own)


def expiry_alerts(near: DataFrame, location: str) -> DataFrame:
    return _alert(near, "near_expiry", location, current_stock=F.col("qty_on_batches"), suggested_qty=F.lit(0))


def restock_plans(levels: DataFrame, now: Column) -> DataFrame:
    """One pending plan per shelf that needs a positive quantity; the id repeats for the same shelf and time."""
    return (
        refill_needed(levels).where("suggested_qty > 0")
        .groupBy("shelf_id").agg(F.max("suggested_qty").cast("int").alias("suggested_qty"))
        .select(
            named_id("restock", now, F.col("shelf_id")).alias("plan_id"), "shelf_id", "suggested_qty",
            F.lit("pending").alias("status"), now.alias("created_at"), now.alias("updated_at"),
        )
    )


def shelf_alerts(state: DataFrame, policies: DataFrame, capacity: DataFrame, lots: DataFrame, history: DataFrame,
                 now: Column, near_days: int = 5, cooldown: int = 60, target_pct: float = S.DEFAULT_TARGET_PCT,
                 all_lots: bool = False) -> tuple[DataFrame, DataFrame]:
    """(alerts, restock plans) for the shelves in state."""
    today = F.to_date(now)
    levels = shelf_levels(state, policies, capacity, target_pct)
    near = near_expiry(soonest_expiry(lots, "batch_quantity_store", today, all_lots), state, today, near_days)
    found = refill_alerts(levels).unionByName(expiry_alerts(near, "store"), allowMissingColumns=True)
    alerts = exclude_recent(found.withColumn("created_at", now), history, ALERT_KEY, "created_at", now, cooldown)
    return alerts, restock_plans(levels, now)


def wh_levels(state: DataFrame, policies: DataFrame) -> DataFrame:
    """Warehouse state with its reorder point; only shelf policies apply here."""
    p = latest_policies(policies).where("shelf_id is not null").select("shelf_id", "reorder_point_qty")
    base = state.select("shelf_id", "wh_current_stock").join(p, "shelf_id", "left")
    return base.withColumn("reorder_point_qty", F.coalesce("reorder_point_qty", F.lit(S.DEFAULT_REORDER_POINT)))


def below_reorder(levels: DataFrame) -> DataFrame:
    return levels.where("wh_current_stock < reorder_point_qty")


def resolved_alerts(levels: DataFrame, now: Column) -> DataFrame:
    """Status changes that close supplier requests of shelves back at their reorder point."""
    return levels.where("wh_current_stock >= reorder_point_qty").select("shelf_id").distinct().select(
        F.lit("alert_status_change").alias("event_type"), F.lit(None).cast("string").alias("alert_id"), "shelf_id",
        F.lit("warehouse").alias("location"), F.lit("supplier_request").alias("alert_event_type"),
        F.lit("resolved").alias("status"), now.alias("timestamp"),
    )


def reorder_alerts(levels: DataFrame) -> DataFrame:
    return _alert(
        below_reorder(levels), "supplier_request", "warehouse", current_stock=F.col("wh_current_stock"),
        min_qty=F.col("reorder_point_qty"), suggested_qty=F.lit(0),
    )


def supplier_plans(levels: DataFrame, sizes: DataFrame, now: Column, multiplier: int = 1) -> DataFrame:
    """One pending supplier plan per shelf below its reorder point, in whole batches where a size is known."""
    gap = S.shortfall("reorder_point_qty", "wh_current_stock")
    rows = below_reorder(levels).join(sizes, "shelf_id", "left").select(
        "shelf_id", F.when(F.col("standard_batch_size") > 0, F.col("standard_batch_size")).alias("standard_batch_size"),
        S.round_up_to_batch(gap, "standard_batch_size", multiplier).alias("suggested_qty"),
    )
    return (
        rows.where("suggested_qty > 0").groupBy("shelf_id")
        .agg(F.max("suggested_qty").cast("int").alias("suggested_qty"), F.max("standard_batch_size").cast("int").alias("standard_batch_size"))
        .select(
            named_id("supplier", now, F.col("shelf_id")).alias("supplier_plan_id"), "shelf_id", "suggested_qty",
            "standard_batch_size", F.lit("pending").alias("status"), now.alias("created_at"), now.alias("updated_at"),
        )
    )


def wh_alerts(state: DataFrame, policies: DataFrame, lots: DataFrame, sizes: DataFrame, history: DataFrame, now: Column,
              near_days: int = 10, cooldown: int = 60, multiplier: int = 1,
              all_lots: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(alerts, resolve events, supplier plans) for the warehouse."""
    today = F.to_date(now)
    levels = wh_levels(state, policies)
    near = near_expiry(soonest_expiry(lots, "batch_quantity_warehouse", today, all_lots), state, today, near_days)
    found = reorder_alerts(levels).unionByName(expiry_alerts(near, "warehouse"), allowMissingColumns=True)
    alerts = exclude_recent(found.withColumn("created_at", now), history, ALERT_KEY, "created_at", now, cooldown)
    return alerts, resolved_alerts(levels, now), supplier_plans(levels, sizes, now, multiplier)


def split_alert_feed(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new alerts, status changes) of the alert feed; rows without a type are neither."""
    changes = feed.where(F.col("event_type") == "alert_status_change")
    return feed.where(F.col("event_type") != "alert_status_change"), changes


def alert_rows(new: DataFrame, now: Column) -> DataFrame:
    """New alerts in the shape of the alert table."""
    return new.select(
        named_id("alert", F.col("created_at"), F.col("location"), F.col("event_type"), F.col("shelf_id")).alias("alert_id"),
        "event_type", "shelf_id", "location", "current_stock", F.lit(None).cast("int").alias("max_stock"),
        F.col("threshold_pct").alias("target_pct"), "suggested_qty", F.lit("open").alias("status"), "created_at",
        now.alias("updated_at"),
    )


def keep_open_plans(plans: DataFrame, fresh: DataFrame, key: str = "shelf_id") -> DataFrame:
    """Plan table after a planning run: a fresh plan replaces a pending one, never one already issued."""
    busy = plans.where("status = 'issued'").select(key)
    incoming = fresh.join(busy, key, "left_anti")
    replaced = incoming.select(key)
    kept = plans.join(replaced.withColumn("status", F.lit("pending")), [key, "status"], "left_anti").select(*plans.columns)
    return kept.unionByName(incoming, allowMissingColumns=True)
