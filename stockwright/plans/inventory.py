"""Current stock per shelf, per warehouse item and per lot."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.latest import latest_per_key
from ..operators.merge import upsert

# Effect of an event on a quantity; other events leave it and still touch the key.
SHELF_SIGN = {"pickup": -1, "putback": 1}
WH_SIGN = {"wh_in": 1, "wh_out": -1}


def signed(qty: str, signs: dict[str, int], event_type: str = "event_type") -> Column:
    out = None
    for event, sign in signs.items():
        delta = F.col(qty) * sign
        is_event = F.col(event_type) == event
        out = F.when(is_event, delta) if out is None else out.when(is_event, delta)
    return out.otherwise(0)


def shelf_deltas(events: DataFrame) -> DataFrame:
    """Net change and last event time per shelf. Shelves whose quantities are all null are left out."""
    return (
        events.groupBy("shelf_id")
        .agg(F.sum(signed("quantity", SHELF_SIGN)).alias("delta"), F.max("ts").alias("event_ts"))
        .where("delta is not null")
    )


def wh_deltas(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("shelf_id")
        .agg(F.sum(signed("qty", WH_SIGN)).alias("delta"), F.max("ts").alias("event_ts"))
        .where("delta is not null")
    )


def add_deltas(state: DataFrame, deltas: DataFrame, stock: str, now: Column,
               extra: dict[str, Column] | None = None) -> DataFrame:
    """State plus net changes; time is the latest of stored, event and processing time."""
    extra = extra or {}
    return upsert(
        state, deltas, ["shelf_id"],
        on_match={
            stock: F.coalesce(F.col(f"t.{stock}"), F.lit(0)) + F.col("s.delta"),
            "last_update_ts": F.greatest(F.col("t.last_update_ts"), F.col("s.event_ts"), now),
            **{c: F.coalesce(v, F.col(f"t.{c}")) for c, v in extra.items()},
        },
        on_insert={
            stock: F.col("s.delta"), "last_update_ts": F.greatest(F.col("s.event_ts"), now), **extra,
        },
    )


def shelf_state(events: DataFrame, opening: DataFrame, profiles: DataFrame, now: Column) -> DataFrame:
    """(shelf_id, current_stock, item_weight, last_update_ts) after the events.

    Events shrink to one row per shelf before they meet opening stock and profiles.
    """
    deltas = shelf_deltas(events).join(profiles.select("shelf_id", "item_weight"), "shelf_id", "left")
    return add_deltas(opening, deltas, "current_stock", now, {"item_weight": F.col("s.item_weight")})


def wh_state(events: DataFrame, opening: DataFrame, now: Column) -> DataFrame:
    """(shelf_id, wh_current_stock, last_update_ts) after the events."""
    return add_deltas(opening, wh_deltas(events), "wh_current_stock", now)


def receipt_lines(receipts: DataFrame) -> DataFrame:
    """One row per receipt item; items without a lot or quantity are left out."""
    flat = receipts.select("transaction_id", "customer_id", "ts", F.explode("items").alias("i")).select(
        "transaction_id", "customer_id", "ts", F.col("i.item_id").alias("item_id"),
        F.col("i.batch_code").alias("batch_code"), F.col("i.quantity").alias("quantity"),
    )
    return flat.where("batch_code is not null and quantity is not null and ts is not null")


def sold_per_lot(lines: DataFrame, lots: DataFrame, match_item: bool = True) -> DataFrame:
    """Sold quantity and last sale per (shelf, lot).

    With match_item the line's item is the shelf; without it the lot code alone finds the shelves,
    and a lot code used on several shelves counts on each of them. Lines are summed before they
    meet the lots, so that join sees one row per key.
    """
    totals = [F.sum("quantity").alias("sold"), F.max("ts").alias("event_ts")]
    if match_item:
        return lines.groupBy(F.col("item_id").alias("shelf_id"), "batch_code").agg(*totals)
    known = lots.select("shelf_id", "batch_code").distinct()
    return known.join(lines.groupBy("batch_code").agg(*totals), "batch_code").select("shelf_id", "batch_code", "sold", "event_ts")


def lots_after_sales(lines: DataFrame, lots: DataFrame, match_item: bool = True) -> DataFrame:
    """Store lots after sales; unknown lots are ignored, quantities may go below zero."""
    return upsert(
        lots, sold_per_lot(lines, lots, match_item), ["shelf_id", "batch_code"],
        on_match={
            "batch_quantity_store": F.coalesce(F.col("t.batch_quantity_store"), F.lit(0)) - F.col("s.sold"),
            "last_update_ts": F.col("s.event_ts"),
        },
    )


def lot_deltas(events: DataFrame) -> DataFrame:
    """Net warehouse change and amount sent to the store per (shelf, lot), in one pass."""
    out = F.when(F.col("event_type") == "wh_out", F.col("qty"))
    out_only = lambda c: F.when(F.col("event_type") == "wh_out", F.col(c))
    return (
        events.where("shelf_id is not null and batch_code is not null and qty is not null")
        .groupBy("shelf_id", "batch_code")
        .agg(
            F.sum(signed("qty", WH_SIGN)).alias("d_wh"), F.sum(out).alias("d_store"),
            F.max("received_date").alias("received_date"), F.max("expiry_date").alias("expiry_date"),
            F.max("ts").alias("ts"),
            F.max(out_only("received_date")).alias("out_received"), F.max(out_only("expiry_date")).alias("out_expiry"),
            F.max(out_only("ts")).alias("out_ts"),
        )
    )


def lots_after_wh_events(events: DataFrame, wh_lots: DataFrame, store_lots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(warehouse lots, store lots) after warehouse events; what leaves the warehouse enters the store lot."""
    deltas = lot_deltas(events)
    key = ["shelf_id", "batch_code"]

    def dates(received, expiry, ts):
        return {
            "received_date": F.coalesce(F.col(f"s.{received}"), F.col("t.received_date")),
            "expiry_date": F.coalesce(F.col(f"s.{expiry}"), F.col("t.expiry_date")),
            "last_update_ts": F.greatest(F.col("t.last_update_ts"), F.col(f"s.{ts}")),
        }

    def fresh(received, expiry, ts):
        return {"received_date": F.col(f"s.{received}"), "expiry_date": F.col(f"s.{expiry}"), "last_update_ts": F.col(f"s.{ts}")}

    wh_qty, store_qty = "batch_quantity_warehouse", "batch_quantity_store"
    warehouse = upsert(
        wh_lots, deltas, key,
        on_match={wh_qty: F.coalesce(F.col(f"t.{wh_qty}"), F.lit(0)) + F.col("s.d_wh"), **dates("received_date", "expiry_date", "ts")},
        on_insert={wh_qty: F.col("s.d_wh"), store_qty: F.lit(0), **fresh("received_date", "expiry_date", "ts")},
    )
    store = upsert(
        store_lots, deltas.where("out_ts is not null"), key,
        on_match={store_qty: F.coalesce(F.col(f"t.{store_qty}"), F.lit(0)) + F.col("s.d_store"), **dates("out_received", "out_expiry", "out_ts")},
        on_insert={store_qty: F.col("s.d_store"), **fresh("out_received", "out_expiry", "out_ts")},
    )
    return warehouse, store


def opening_state(snapshot: DataFrame, keys: Sequence[str], order_by: Sequence[str], now: Column,
                  ts_col: str = "last_update_ts") -> DataFrame:
    """Latest snapshot row per key, stamped with the load time."""
    return latest_per_key(snapshot, keys, order_by).withColumn(ts_col, now)


def total_stock(shelf: DataFrame, wh: DataFrame) -> DataFrame:
    """Shelf plus warehouse stock per product."""
    s = shelf.select("shelf_id", "current_stock", F.col("last_update_ts").alias("_a"))
    w = wh.select("shelf_id", "wh_current_stock", F.col("last_update_ts").alias("_b"))
    total = F.coalesce(F.col("current_stock"), F.lit(0)) + F.coalesce(F.col("wh_current_stock"), F.lit(0))
    return s.join(w, "shelf_id", "full").select(
        "shelf_id", total.cast("int").alias("total_stock"), F.greatest("_a", "_b").alias("last_update_ts")
    )


def expired(lots: DataFrame, today: Column, mode: str = "next_day") -> DataFrame:
    """Lots to take off the shelf: past their date, or on the evening of the date itself."""
    if mode not in ("next_day", "same_day_evening"):
        raise ValueError(f"unknown removal mode {mode!r}")
    due = F.col("expiry_date") < today if mode == "next_day" else F.col("expiry_date") <= today
    return lots.where(due & (F.col("batch_quantity_store") > 0))


def remove_expired(shelf: DataFrame, lots: DataFrame, today: Column, now: Column, mode: str = "next_day",
                   alert_per_lot: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(shelf state, lots, alerts): expired lots set to zero, their total taken off the shelf, not below zero.

    One alert per shelf with the removed total; alert_per_lot raises it once for every lot instead.
    """
    gone = expired(lots, today, mode)
    per_shelf = gone.groupBy("shelf_id").agg(F.sum("batch_quantity_store").alias("removed"))
    shelf_after = upsert(
        shelf, per_shelf, ["shelf_id"],
        on_match={
            "current_stock": F.greatest(F.lit(0), F.col("t.current_stock") - F.col("s.removed")),
            "last_update_ts": now,
        },
    )
    is_gone = (F.col("expiry_date") < today if mode == "next_day" else F.col("expiry_date") <= today) & (
        F.col("batch_quantity_store") > 0
    )
    is_gone = F.coalesce(is_gone, F.lit(False))
    lots_after = lots.withColumn("last_update_ts", F.when(is_gone, now).otherwise(F.col("last_update_ts"))).withColumn(
        "batch_quantity_store", F.when(is_gone, 0).otherwise(F.col("batch_quantity_store"))
    )
    base = gone.select("shelf_id").join(per_shelf, "shelf_id") if alert_per_lot else per_shelf
    alerts = base.select(
        F.lit("expired_removal").alias("event_type"), "shelf_id", F.lit("store").alias("location"),
        F.col("removed").cast("int").alias("suggested_qty"), now.alias("created_at"),
    )
    return shelf_after, lots_after, alerts
