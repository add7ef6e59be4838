"""Queries over shelf, warehouse and lot state."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.latest import touched
from ..operators.merge import upsert
from ..plans import config, inventory as inv
from ..plans.alerts import refill_needed, resolve_policy, shelf_levels
from .fixtures import NOW, OPENING_SHELF, OPENING_WH, TODAY, Inputs, now_ts, oracle, today

TS = f"TIMESTAMP '{NOW}'"
DAY = f"DATE '{TODAY}'"

SHELF_DELTA = """SELECT shelf_id, SUM(CASE event_type WHEN 'pickup' THEN -quantity WHEN 'putback' THEN quantity ELSE 0 END) AS delta,
  MAX(ts) AS ts FROM shelf_events GROUP BY shelf_id"""
WH_DELTA = """SELECT shelf_id, SUM(CASE event_type WHEN 'wh_in' THEN qty ELSE -qty END) AS delta, MAX(ts) AS ts
  FROM wh_events GROUP BY shelf_id"""
SHELF_STATE = f"""SELECT COALESCE(o.shelf_id, d.shelf_id) AS shelf_id,
  CAST(COALESCE(o.current_stock, 0) + COALESCE(d.delta, 0) AS INT) AS current_stock, o.item_weight,
  CASE WHEN d.shelf_id IS NULL THEN o.last_update_ts ELSE GREATEST(o.last_update_ts, d.ts, {TS}) END AS last_update_ts
  FROM opening o FULL JOIN delta d ON o.shelf_id = d.shelf_id"""
WH_STATE = f"""SELECT COALESCE(o.shelf_id, d.shelf_id) AS shelf_id,
  CAST(COALESCE(o.wh_current_stock, 0) + COALESCE(d.delta, 0) AS INT) AS wh_current_stock,
  CASE WHEN d.shelf_id IS NULL THEN o.last_update_ts ELSE GREATEST(o.last_update_ts, d.ts, {TS}) END AS last_update_ts
  FROM wh_opening o FULL JOIN wh_delta d ON o.shelf_id = d.shelf_id"""
SHELF_PARTS = {"opening": OPENING_SHELF, "delta": SHELF_DELTA, "state": SHELF_STATE}
WH_PARTS = {"wh_opening": OPENING_WH, "wh_delta": WH_DELTA, "wh_state": WH_STATE}
POLICY_LATEST = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shelf_id ORDER BY updated_at DESC) AS rn
  FROM shelf_policies) WHERE rn = 1 AND active"""
LEVELS = """SELECT s.shelf_id, s.current_stock, p.threshold_pct, p.min_qty, p.stock_pct, p.cap,
  CASE WHEN p.cap IS NOT NULL THEN GREATEST(0, CEIL(p.cap * 80.0 / 100) - s.current_stock)
       ELSE GREATEST(0, p.min_qty - s.current_stock) END AS suggested_qty
  FROM state s JOIN (
    SELECT s.shelf_id, COALESCE(o.threshold_pct, g.threshold_pct, 30.0) AS threshold_pct, COALESCE(o.min_qty, g.min_qty, 1) AS min_qty,
           i.maximum_stock AS cap, CASE WHEN i.maximum_stock > 0 THEN s.current_stock * 100.0 / i.maximum_stock END AS stock_pct
    FROM state s LEFT JOIN policy o ON s.shelf_id = o.shelf_id
    LEFT JOIN (SELECT * FROM policy WHERE shelf_id IS NULL) g ON TRUE
    LEFT JOIN inventory i ON s.shelf_id = i.shelf_id) p ON s.shelf_id = p.shelf_id"""
REFILL = "SELECT * FROM levels WHERE (stock_pct IS NOT NULL AND stock_pct < threshold_pct) OR current_stock < min_qty"
LEVEL_PARTS = {**SHELF_PARTS, "policy": POLICY_LATEST, "levels": LEVELS, "refill": REFILL}


def state_of(i: Inputs):
    return inv.shelf_state(i["shelf_events"], i.opening_shelf, i.profiles, now_ts())


def wh_state_of(i: Inputs):
    return inv.wh_state(i["wh_events"], i.opening_wh, now_ts())


def levels_of(i: Inputs):
    return shelf_levels(state_of(i), i["shelf_policies"], i["inventory"])


def q_refill_alerts(i: Inputs):
    r = refill_needed(levels_of(i))
    return r.select("shelf_id", "current_stock", "threshold_pct", "min_qty", F.round("stock_pct", 6).alias("stock_pct"),
                    F.col("suggested_qty").cast("int").alias("suggested_qty"))


def q_lot_sales(i: Inputs):
    return inv.lots_after_sales(i["receipt_lines"].where("batch_code is not null"), i.store_lots)


def q_lot_sales_by_code(i: Inputs):
    lines = i["receipt_lines"].where("batch_code is not null")
    return inv.sold_per_lot(lines, i.store_lots, match_item=False).select("shelf_id", "batch_code", "sold", "event_ts")


def nested_receipts(i: Inputs):
    """Receipts of one item and its repetition without a lot, nested as the till sends them."""
    item = lambda lot: F.struct("item_id", lot.alias("batch_code"), "quantity")
    return i["receipt_lines"].select(
        "transaction_id", "customer_id", "ts", F.array(item(F.col("batch_code")), item(F.lit(None).cast("string"))).alias("items")
    )


def lots_after(i: Inputs):
    return inv.lots_after_wh_events(i["wh_events"], i.wh_lots, i.store_lots)


def q_upsert(i: Inputs):
    """Newer policy revisions merged into the older ones; unknown shelves are added."""
    p = i["shelf_policies"].where("shelf_id is not null")
    old = p.where(F.col("updated_at") < F.lit("1998-01-01").cast("date"))
    new = p.where(F.col("updated_at") >= F.lit("1998-01-10").cast("date"))
    src = lambda c: F.col(f"s.{c}")
    merged = {"threshold_pct": F.greatest("t.threshold_pct", "s.threshold_pct"), "updated_at": src("updated_at")}
    return upsert(old, new, ["shelf_id"], merged, {c: src(c) for c in ("threshold_pct", "min_qty", "active", "updated_at")})


def q_update_only(i: Inputs):
    sold = i["receipt_lines"].groupBy(F.col("item_id").alias("shelf_id")).agg(F.sum("quantity").alias("sold"))
    base = i["inventory"].where("item_category <> 'SMALL'").select("shelf_id", "current_stock")
    return upsert(base, sold, ["shelf_id"], {"current_stock": F.col("t.current_stock") - F.col("s.sold")})


def q_touched(i: Inputs):
    day = i["shelf_events"].where(F.col("ts") >= now_ts())
    return touched(i["inventory"].select("shelf_id", "current_stock"), day, ["shelf_id"])


def q_policy_latest(i: Inputs):
    return config.latest_policies(i["shelf_policies"]).select("shelf_id", "threshold_pct", "min_qty", "updated_at")


def q_policy_resolved(i: Inputs):
    return resolve_policy(i["inventory"].select("shelf_id"), i["shelf_policies"])


def q_total(i: Inputs):
    return inv.total_stock(state_of(i), wh_state_of(i))


def q_removal_shelf(i: Inputs):
    return inv.remove_expired(i.opening_shelf, i.store_lots, today(), now_ts())[0].select("shelf_id", "current_stock", "last_update_ts")


def q_removal_lots(i: Inputs):
    return inv.remove_expired(i.opening_shelf, i.store_lots, today(), now_ts(), "same_day_evening")[1].select(
        "shelf_id", "batch_code", "batch_quantity_store", "last_update_ts"
    )


def q_removal_alerts(i: Inputs):
    return inv.remove_expired(i.opening_shelf, i.store_lots, today(), now_ts())[2]


def q_opening(i: Inputs):
    """Latest event row per lot taken as a snapshot row."""
    snap = i["wh_events"].select("shelf_id", "batch_code", "qty", "ts", "event_id")
    return inv.opening_state(snap, ["shelf_id", "batch_code"], ["ts", "event_id", "qty"], now_ts(), "loaded_at")


QUERIES = {
    "shelf_state": lambda i: state_of(i),
    "refill_alerts": q_refill_alerts,
    "policy_latest": q_policy_latest,
    "policy_resolved": q_policy_resolved,
    "wh_state": lambda i: wh_state_of(i),
    "lot_state_from_sales": lambda i: q_lot_sales(i).select("shelf_id", "batch_code", "batch_quantity_store", "last_update_ts"),
    "lot_sales_by_code": q_lot_sales_by_code,
    "receipt_lines": lambda i: inv.receipt_lines(nested_receipts(i)),
    "wh_lot_state": lambda i: lots_after(i)[0],
    "store_lot_state": lambda i: lots_after(i)[1],
    "upsert_merge": q_upsert,
    "update_only_merge": q_update_only,
    "touched_keys": q_touched,
    "total_stock": q_total,
    "expired_removal": q_removal_shelf,
    "expired_removal_lots": q_removal_lots,
    "expired_removal_alerts": q_removal_alerts,
    "opening_state": q_opening,
}

_lots = lambda qty, extra="": f"SELECT shelf_id, batch_code, received_date, expiry_date, qty AS {qty}{extra}, last_update_ts FROM wh_lots"
_lot_delta = """SELECT shelf_id, batch_code, SUM(CASE WHEN event_type = 'wh_in' THEN qty ELSE -qty END) AS d_wh, MAX(received_date) AS rd,
  MAX(expiry_date) AS ed, MAX(ts) AS ts FROM wh_events GROUP BY shelf_id, batch_code"""
_store_delta = """SELECT shelf_id, batch_code, SUM(qty) AS d_store, MAX(received_date) AS rd, MAX(expiry_date) AS ed, MAX(ts) AS ts
  FROM wh_events WHERE event_type = 'wh_out' GROUP BY shelf_id, batch_code"""
_expired = f"SELECT shelf_id, SUM(qty) AS removed FROM wh_lots WHERE expiry_date < {DAY} AND qty > 0 GROUP BY shelf_id"

ORACLES = {
    "shelf_state": oracle("SELECT * FROM state", "inventory", "shelf_events", **SHELF_PARTS),
    "refill_alerts": oracle(
        """SELECT shelf_id, current_stock, threshold_pct, min_qty, ROUND(stock_pct, 6) AS stock_pct,
           CAST(suggested_qty AS INT) AS suggested_qty FROM refill""", "inventory", "shelf_events", "shelf_policies", **LEVEL_PARTS),
    "policy_latest": oracle("SELECT shelf_id, threshold_pct, min_qty, updated_at FROM policy", "shelf_policies", policy=POLICY_LATEST),
    "policy_resolved": oracle(
        """SELECT i.shelf_id, COALESCE(o.threshold_pct, (SELECT threshold_pct FROM policy WHERE shelf_id IS NULL), 30.0) AS threshold_pct,
           COALESCE(o.min_qty, (SELECT min_qty FROM policy WHERE shelf_id IS NULL), 1) AS min_qty
           FROM inventory i LEFT JOIN policy o ON i.shelf_id = o.shelf_id""", "inventory", "shelf_policies", policy=POLICY_LATEST),
    "wh_state": oracle("SELECT * FROM wh_state", "inventory", "wh_events", **WH_PARTS),
    "lot_state_from_sales": oracle(
        """SELECT l.shelf_id, l.batch_code, CAST(l.qty - COALESCE(s.sold, 0) AS INT) AS batch_quantity_store,
           COALESCE(s.ts, l.last_update_ts) AS last_update_ts FROM wh_lots l LEFT JOIN
           (SELECT item_id, batch_code, SUM(quantity) AS sold, MAX(ts) AS ts FROM receipt_lines GROUP BY item_id, batch_code) s
           ON l.shelf_id = s.item_id AND l.batch_code = s.batch_code""", "wh_lots", "receipt_lines"),
    "lot_sales_by_code": oracle(
        """SELECT l.shelf_id, l.batch_code, CAST(SUM(r.quantity) AS BIGINT) AS sold, MAX(r.ts) AS event_ts
           FROM wh_lots l JOIN receipt_lines r ON l.batch_code = r.batch_code GROUP BY l.shelf_id, l.batch_code""", "wh_lots", "receipt_lines"),
    "receipt_lines": oracle(
        "SELECT transaction_id, customer_id, ts, item_id, batch_code, quantity FROM receipt_lines WHERE batch_code IS NOT NULL", "receipt_lines"),
    "wh_lot_state": oracle(
        """SELECT t.shelf_id, t.batch_code, COALESCE(s.rd, t.received_date) AS received_date, COALESCE(s.ed, t.expiry_date) AS expiry_date,
           CAST(t.qty + COALESCE(s.d_wh, 0) AS INT) AS batch_quantity_warehouse, 0 AS batch_quantity_store,
           GREATEST(t.last_update_ts, s.ts) AS last_update_ts
           FROM wh_lots t LEFT JOIN d s ON t.shelf_id = s.shelf_id AND t.batch_code = s.batch_code""", "wh_lots", "wh_events", d=_lot_delta),
    "store_lot_state": oracle(
        """SELECT t.shelf_id, t.batch_code, COALESCE(s.rd, t.received_date) AS received_date, COALESCE(s.ed, t.expiry_date) AS expiry_date,
           CAST(t.qty + COALESCE(s.d_store, 0) AS INT) AS batch_quantity_store, GREATEST(t.last_update_ts, s.ts) AS last_update_ts
           FROM wh_lots t LEFT JOIN d s ON t.shelf_id = s.shelf_id AND t.batch_code = s.batch_code""", "wh_lots", "wh_events", d=_store_delta),
    "upsert_merge": oracle(
        """SELECT COALESCE(t.shelf_id, s.shelf_id) AS shelf_id,
           CASE WHEN t.shelf_id IS NULL THEN s.threshold_pct WHEN s.shelf_id IS NULL THEN t.threshold_pct
                ELSE GREATEST(t.threshold_pct, s.threshold_pct) END AS threshold_pct,
           COALESCE(t.min_qty, s.min_qty) AS min_qty, COALESCE(t.active, s.active) AS active, COALESCE(s.updated_at, t.updated_at) AS updated_at
           FROM (SELECT * FROM shelf_policies WHERE shelf_id IS NOT NULL AND updated_at < DATE '1998-01-01') t
           FULL JOIN (SELECT * FROM shelf_policies WHERE shelf_id IS NOT NULL AND updated_at >= DATE '1998-01-10') s ON t.shelf_id = s.shelf_id""",
        "shelf_policies"),
    "update_only_merge": oracle(
        """SELECT i.shelf_id, CAST(i.current_stock - COALESCE(s.sold, 0) AS INT) AS current_stock FROM inventory i LEFT JOIN
           (SELECT item_id, SUM(quantity) AS sold FROM receipt_lines GROUP BY item_id) s ON i.shelf_id = s.item_id
           WHERE i.item_category <> 'SMALL'""", "inventory", "receipt_lines"),
    "touched_keys": oracle(
        f"SELECT shelf_id, current_stock FROM inventory WHERE shelf_id IN (SELECT shelf_id FROM shelf_events WHERE ts >= {TS})",
        "inventory", "shelf_events"),
    "total_stock": oracle(
        """SELECT COALESCE(a.shelf_id, b.shelf_id) AS shelf_id,
           CAST(COALESCE(a.current_stock, 0) + COALESCE(b.wh_current_stock, 0) AS INT) AS total_stock,
           GREATEST(a.last_update_ts, b.last_update_ts) AS last_update_ts
           FROM state a FULL JOIN wh_state b ON a.shelf_id = b.shelf_id""",
        "inventory", "shelf_events", "wh_events", **SHELF_PARTS, **WH_PARTS),
    "expired_removal": oracle(
        f"""SELECT i.shelf_id, CAST(CASE WHEN e.removed IS NULL THEN i.current_stock ELSE GREATEST(0, i.current_stock - e.removed) END AS INT) AS current_stock,
           CASE WHEN e.removed IS NULL THEN TIMESTAMP '1998-01-01 00:00:00' ELSE {TS} END AS last_update_ts
           FROM inventory i LEFT JOIN e ON i.shelf_id = e.shelf_id""", "inventory", "wh_lots", e=_expired),
    "expired_removal_lots": oracle(
        f"""SELECT shelf_id, batch_code, CASE WHEN expiry_date <= {DAY} AND qty > 0 THEN 0 ELSE qty END AS batch_quantity_store,
           CASE WHEN expiry_date <= {DAY} AND qty > 0 THEN {TS} ELSE last_update_ts END AS last_update_ts FROM wh_lots""", "wh_lots"),
    "expired_removal_alerts": oracle(
        f"""SELECT 'expired_removal' AS event_type, shelf_id, 'store' AS location, CAST(removed AS INT) AS suggested_qty, {TS} AS created_at FROM e""",
        "wh_lots", e=_expired),
    "opening_state": oracle(
        f"""SELECT shelf_id, batch_code, qty, ts, event_id, {TS} AS loaded_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shelf_id, batch_code
           ORDER BY ts DESC, event_id DESC, qty DESC) AS rn FROM wh_events) WHERE rn = 1""", "wh_events"),
}
