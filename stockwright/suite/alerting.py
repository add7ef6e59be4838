"""Queries over alerts, plans, allocation and the supplier ledger."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import uuid5, uuid5_mod
from ..functions.stock import order_qty, deliverable
from ..functions.times import next_delivery
from ..operators.align import align_to_schema
from ..operators.allocate import allocate, apportion, shortage, split_batches
from ..operators.merge import apply_status
from ..plans import alerts as A, planning as P
from ..schemas import ALERTS, SUPPLIER_ORDERS, SUPPLIER_PLAN, SUPPLIER_RECEIPTS
from .fixtures import Inputs, now_ts, oracle, today
from .state import DAY, LEVEL_PARTS, TS, WH_PARTS, levels_of, state_of, wh_state_of


def uuid_sql(name: str) -> str:
    """Name-based id in the check's SQL."""
    h = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"substr('89ab', CAST('0x' || substr({h}, 17, 1) AS INT) % 4 + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def uuid_mod_sql(name: str) -> str:
    u = f"replace({uuid_sql(name)}, '-', '')"
    return f"CAST(CAST('0x' || substr({u}, 1, 31) AS HUGEINT) % 1000000 * 16 % 1000000 + CAST('0x' || substr({u}, 32, 1) AS INT) AS BIGINT) % 1000000"


def history(i: Inputs):
    return i["recent_alerts"]


def rounded(df):
    return df.withColumn("stock_pct", F.round("stock_pct", 6)) if "stock_pct" in df.columns else df


def q_near_store(i: Inputs):
    near = A.near_expiry(A.soonest_expiry(i.store_lots, "batch_quantity_store", today()), i["inventory"], today(), 5)
    return near.select("shelf_id", "min_expiry", "qty_on_batches", "days_to_expiry")


def q_near_wh(i: Inputs):
    near = A.near_expiry(A.soonest_expiry(i.wh_lots, "batch_quantity_warehouse", today()), i["inventory"], today(), 10)
    return near.select("shelf_id", "min_expiry", "qty_on_batches", "days_to_expiry")


def q_near_all_lots(i: Inputs):
    day = F.lit("1995-06-01").cast("date")
    near = A.near_expiry(A.soonest_expiry(i.store_lots, "batch_quantity_store", day, all_lots=True), i["inventory"], day, 400)
    return near.select("shelf_id", "min_expiry", "qty_on_batches", "days_to_expiry")


def q_shelf_alerts(i: Inputs):
    return rounded(A.shelf_alerts(state_of(i), i["shelf_policies"], i["inventory"], i.store_lots, history(i), now_ts())[0])


def q_restock_plan(i: Inputs):
    return A.restock_plans(levels_of(i), now_ts())


def wh_levels_of(i: Inputs):
    return A.wh_levels(wh_state_of(i), i["wh_policies"])


def q_wh_alerts(i: Inputs):
    sizes = i["inventory"].select("shelf_id", "standard_batch_size")
    return A.wh_alerts(wh_state_of(i), i["wh_policies"], i.wh_lots, sizes, history(i), now_ts())[0]


def q_supplier_plan(i: Inputs):
    sizes = i["inventory"].where("item_category <> 'LARGE'").select("shelf_id", "standard_batch_size")
    return A.supplier_plans(wh_levels_of(i), sizes, now_ts(), multiplier=2)


def status_alerts(i: Inputs):
    return align_to_schema(i["alert_history"].withColumn("updated_at", F.col("created_at")), ALERTS)


def q_alert_status(i: Inputs):
    return apply_status(status_alerts(i), i["status_changes"], now_ts()).select("alert_id", "status", "updated_at")


def mature(i: Inputs):
    return P.mature_plans(i["restock_plans"], now_ts(), 60)


def q_fifo(i: Inputs):
    return P.fifo_allocation(mature(i), i.wh_lots)


def q_fifo_per_plan(i: Inputs):
    return P.fifo_allocation(mature(i), i.wh_lots, per_plan=True)


def sold(i: Inputs):
    e = i["shelf_events"].where("event_type = 'pickup'")
    return e.groupBy("shelf_id").agg(F.sum("quantity").cast("int").alias("wanted"))


def fefo(i: Inputs):
    lots = i.store_lots.select("shelf_id", "expiry_date", "batch_code", "batch_quantity_store")
    return allocate(sold(i), lots, "shelf_id", ["wanted"], P.FEFO, "wanted", "batch_quantity_store")


def q_fefo(i: Inputs):
    return fefo(i).select("shelf_id", "batch_code", "expiry_date", F.col("take").cast("bigint").alias("take"))


def q_shortage(i: Inputs):
    return shortage(mature(i), q_fifo(i).withColumnRenamed("alloc_qty", "take"), ["plan_id"], "suggested_qty")


def q_transfer(i: Inputs):
    after, moved = P.transfer(i.wh_lots.select("shelf_id", "batch_code", "expiry_date", "batch_quantity_warehouse"), sold(i), "shelf_id",
                              "batch_quantity_warehouse", "wanted")
    tag = lambda df, side: df.withColumn("side", F.lit(side))
    return tag(after, "source").unionByName(tag(moved, "destination"))


def q_split(i: Inputs):
    rows = split_batches(i["inventory"], "current_stock", "standard_batch_size")
    return rows.select("shelf_id", "batch_no", F.col("batch_qty").cast("int").alias("batch_qty"))


def q_issued(i: Inputs):
    plans = i["restock_plans"].withColumn("updated_at", F.col("created_at"))
    return P.issue_restock(plans, i.wh_lots, now_ts())[1]


def q_wh_out(i: Inputs):
    plans = i["restock_plans"].withColumn("updated_at", F.col("created_at"))
    return P.issue_restock(plans, i.wh_lots, now_ts())[0].select("event_id", "plan_id", "shelf_id", "batch_code", "qty", "timestamp")


def q_acks(i: Inputs):
    plans = i["restock_plans"].withColumn("updated_at", F.col("created_at"))
    return P.issue_restock(plans, i.wh_lots, now_ts())[2].select("shelf_id", "plan_id", "status", "moved")


def q_apportion(i: Inputs):
    """Event total of a day spread over its types in proportion to the summed values."""
    per_type = i.sql("""SELECT CAST(ts AS DATE) AS day, event_type, CAST(SUM(CAST(value * 100 AS DECIMAL(12,0))) AS BIGINT) AS weight,
                        COUNT(*) AS n FROM events GROUP BY CAST(ts AS DATE), event_type""")
    total = per_type.groupBy("day").agg(F.sum("n").cast("int").alias("total"))
    return apportion(per_type.join(total, "day"), ["day"], "total", "weight", "event_type").select("day", "event_type", "total", "share")


def orders_in(i: Inputs):
    return align_to_schema(i["supplier_orders"], SUPPLIER_ORDERS)


def plans_in(i: Inputs):
    return align_to_schema(i["supplier_plans"], SUPPLIER_PLAN)


def q_supplier_orders(i: Inputs):
    return P.supplier_cutoff(plans_in(i), orders_in(i), now_ts())[0].select(
        "order_id", "delivery_date", "shelf_id", "total_qty", "status", "cutoff_ts", "delivery_ts", "created_at", "updated_at"
    )


def q_cutoff_plans(i: Inputs):
    return P.supplier_cutoff(plans_in(i), orders_in(i), now_ts())[1].select("supplier_plan_id", "status", "updated_at")


def delivery(i: Inputs):
    return P.supplier_delivery(orders_in(i), align_to_schema(i["supplier_receipts"], SUPPLIER_RECEIPTS), plans_in(i), now_ts())


def q_next_delivery(i: Inputs):
    o = i.sql("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS ts FROM orders")
    return o.select("o_orderkey", next_delivery("ts").alias("delivery_date"))


def q_uuid5(i: Inputs):
    name = F.concat(F.lit("wh_in:1998-06-01:"), "shelf_id", F.lit("é"))
    return i["inventory"].select("shelf_id", uuid5(name).alias("id"), uuid5_mod(name).alias("draw"))


def q_order_qty(i: Inputs):
    demand = F.col("item_weight") / 3
    rows = i["inventory"].select("shelf_id", order_qty(
        F.col("current_stock"), F.col("standard_batch_size"), F.col("maximum_stock"), demand * 100, F.col("standard_batch_size"),
        F.col("warehouse_capacity")).cast("bigint").alias("order_qty"))
    return rows


def q_capped(i: Inputs):
    pending = i["supplier_plans"].groupBy("shelf_id").agg(F.sum("suggested_qty").alias("pending"))
    j = i["inventory"].join(pending, "shelf_id")
    got = deliverable(F.col("pending"), F.col("maximum_stock"), F.col("current_stock"))
    return j.select("shelf_id", got.cast("bigint").alias("delivered"), (F.col("pending") - got).cast("bigint").alias("carried_over"))


QUERIES = {
    "near_expiry_store": q_near_store,
    "near_expiry_wh": q_near_wh,
    "near_expiry_all_lots": q_near_all_lots,
    "alerts_with_cooldown": q_shelf_alerts,
    "restock_plan": q_restock_plan,
    "reorder_alerts": lambda i: A.reorder_alerts(wh_levels_of(i)).select("event_type", "shelf_id", "location", "current_stock", "min_qty"),
    "wh_alerts_with_cooldown": q_wh_alerts,
    "resolved_alerts": lambda i: A.resolved_alerts(wh_levels_of(i), now_ts()).select("shelf_id", "location", "alert_event_type", "status", "timestamp"),
    "supplier_plan": q_supplier_plan,
    "alert_status": q_alert_status,
    "fifo_allocation": q_fifo,
    "fifo_allocation_per_plan": q_fifo_per_plan,
    "fefo_allocation": q_fefo,
    "allocation_shortage": q_shortage,
    "lot_transfer": q_transfer,
    "split_into_batches": q_split,
    "plan_issued": q_issued,
    "restock_wh_out": q_wh_out,
    "restock_acks": q_acks,
    "slot_apportionment": q_apportion,
    "supplier_orders": q_supplier_orders,
    "supplier_cutoff_plans": q_cutoff_plans,
    "supplier_delivery": lambda i: delivery(i)[0].select(
        "event_type", "event_id", "shelf_id", "batch_code", "qty", "timestamp", "received_date", "expiry_date", "reason"),
    "supplier_receipts": lambda i: delivery(i)[1],
    "supplier_delivered_orders": lambda i: delivery(i)[2].select("order_id", "status", "delivery_ts", "updated_at"),
    "supplier_completed_plans": lambda i: delivery(i)[3].select("supplier_plan_id", "status", "updated_at"),
    "next_delivery": q_next_delivery,
    "uuid5_ids": q_uuid5,
    "order_quantity": q_order_qty,
    "capped_delivery": q_capped,
}

_near = lambda days: f"""SELECT shelf_id, MIN(expiry_date) AS min_expiry, CAST(SUM(qty) AS BIGINT) AS qty_on_batches,
  CAST(MIN(expiry_date) - {DAY} AS INT) AS days_to_expiry FROM wh_lots WHERE qty > 0 AND expiry_date >= {DAY} GROUP BY shelf_id
  HAVING MIN(expiry_date) - {DAY} <= {days}"""
_cool = f"""NOT EXISTS (SELECT 1 FROM recent_alerts r WHERE r.created_at >= {TS} - INTERVAL '60' MINUTE AND r.event_type = a.event_type
  AND r.shelf_id = a.shelf_id AND r.location = a.location)"""
_wh_policy = """SELECT shelf_id, reorder_point_qty FROM wh_policies WHERE active"""
_wh_levels = """SELECT s.shelf_id, s.wh_current_stock, COALESCE(p.reorder_point_qty, 10) AS rop FROM wh_state s
  LEFT JOIN wh_policy p ON s.shelf_id = p.shelf_id"""
WH_LEVEL_PARTS = {**WH_PARTS, "wh_policy": _wh_policy, "wh_levels": _wh_levels}
_nulls = "CAST(NULL AS DOUBLE) AS threshold_pct, CAST(NULL AS DOUBLE) AS stock_pct"
_mature = f"SELECT * FROM restock_plans WHERE status = 'pending' AND created_at <= {TS} - INTERVAL '60' SECOND"
_plan_line = """SELECT *, SUM(suggested_qty) OVER (PARTITION BY shelf_id ORDER BY created_at, plan_id ROWS UNBOUNDED PRECEDING) AS d1
  FROM mature WHERE suggested_qty > 0"""
_lot_line = """SELECT *, SUM(qty) OVER (PARTITION BY shelf_id ORDER BY received_date, expiry_date, batch_code ROWS UNBOUNDED PRECEDING) AS s1
  FROM wh_lots WHERE qty > 0"""
_fifo = """SELECT p.plan_id, p.shelf_id, l.batch_code, l.received_date, l.expiry_date,
  CAST(LEAST(p.d1, l.s1) - GREATEST(p.d1 - p.suggested_qty, l.s1 - l.qty) AS INT) AS alloc_qty
  FROM plan_line p JOIN lot_line l ON p.shelf_id = l.shelf_id
  AND LEAST(p.d1, l.s1) > GREATEST(p.d1 - p.suggested_qty, l.s1 - l.qty)"""
FIFO_PARTS = {"mature": _mature, "plan_line": _plan_line, "lot_line": _lot_line, "fifo": _fifo}
_sold = "SELECT shelf_id, CAST(SUM(quantity) AS INT) AS wanted FROM shelf_events WHERE event_type = 'pickup' GROUP BY shelf_id"
_fefo = """SELECT l.shelf_id, l.batch_code, l.expiry_date, l.qty, CAST(LEAST(l.qty, s.wanted - (l.s1 - l.qty)) AS BIGINT) AS take
  FROM (SELECT *, SUM(qty) OVER (PARTITION BY shelf_id ORDER BY expiry_date, batch_code ROWS UNBOUNDED PRECEDING) AS s1
        FROM wh_lots WHERE qty > 0) l JOIN sold s ON l.shelf_id = s.shelf_id WHERE s.wanted > l.s1 - l.qty"""
_delivery_day = "DATE '1998-06-03'"
_new_orders = f"""SELECT {uuid_sql("'wh_supplier_order:1998-06-03:' || shelf_id")} AS order_id, {_delivery_day} AS delivery_date, shelf_id,
  CAST(SUM(suggested_qty) AS INT) AS total_qty FROM supplier_plans WHERE lower(trim(status)) = 'pending' GROUP BY shelf_id"""
_due = f"""SELECT * FROM supplier_orders o WHERE delivery_date = {DAY} AND status = 'issued' AND NOT EXISTS
  (SELECT 1 FROM supplier_receipts r WHERE r.delivery_date = o.delivery_date AND r.shelf_id = o.shelf_id)"""
_changes = """SELECT *, CASE WHEN lower(trim(status)) IN ('open','active','pending','new') THEN 'open'
  WHEN lower(trim(status)) IN ('ack','acknowledged') THEN 'ack' WHEN lower(trim(status)) IN ('resolved','closed','done') THEN 'resolved'
  WHEN lower(trim(status)) IN ('dismissed','ignored') THEN 'dismissed' ELSE 'ack' END AS st FROM status_changes"""
# The changes in order of seq: the last that names an alert, then those for its place while it is live, up to the first that closes it.
_named = "SELECT alert_id, st, seq FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY alert_id ORDER BY seq DESC) AS rn FROM changes WHERE alert_id IS NOT NULL) WHERE rn = 1"
_base = """SELECT h.*, COALESCE(n.st, h.status) AS st0, COALESCE(n.seq, -1) AS since, n.st AS named_st
  FROM alert_history h LEFT JOIN named n ON h.alert_id = n.alert_id"""
_keyed = """SELECT b.alert_id, c.st, ROW_NUMBER() OVER (PARTITION BY b.alert_id ORDER BY
  CASE WHEN c.st IN ('resolved','dismissed') THEN 0 ELSE 1 END, CASE WHEN c.st IN ('resolved','dismissed') THEN c.seq ELSE -c.seq END) AS rn
  FROM (SELECT * FROM base WHERE st0 IN ('open','ack')) b
  JOIN (SELECT DISTINCT shelf_id, location, alert_event_type, st, seq FROM changes WHERE alert_id IS NULL) c
  ON b.shelf_id = c.shelf_id AND b.location = c.location AND (c.alert_event_type IS NULL OR c.alert_event_type = b.event_type) AND c.seq > b.since"""
_dow = "(dayofweek(d) + 6) % 7"

ORACLES = {
    "near_expiry_store": oracle(_near(5), "wh_lots"),
    "near_expiry_wh": oracle(_near(10), "wh_lots"),
    "near_expiry_all_lots": oracle(
        """SELECT shelf_id, MIN(expiry_date) AS min_expiry, CAST(SUM(qty) AS BIGINT) AS qty_on_batches,
            CAST(MIN(expiry_date) - DATE '1995-06-01' AS INT) AS days_to_expiry FROM wh_lots GROUP BY shelf_id
            HAVING MIN(expiry_date) - DATE '1995-06-01' BETWEEN 0 AND 400""", "wh_lots"),
    "alerts_with_cooldown": oracle(
        f"""SELECT * FROM (SELECT 'refill_request' AS event_type, shelf_id, 'store' AS location, current_stock, min_qty, threshold_pct,
              ROUND(stock_pct, 6) AS stock_pct, CAST(suggested_qty AS INT) AS suggested_qty, {TS} AS created_at FROM refill
            UNION ALL SELECT 'near_expiry', shelf_id, 'store', CAST(qty_on_batches AS INT), CAST(NULL AS INT), {_nulls.replace(' AS threshold_pct', '').replace(' AS stock_pct', '')}, 0, {TS}
            FROM near) a WHERE {_cool}""",
        "inventory", "shelf_events", "shelf_policies", "wh_lots", "recent_alerts", **LEVEL_PARTS, near=_near(5)),
    "restock_plan": oracle(
        f"""SELECT {uuid_sql("'restock:1998-06-01 12:00:00:' || shelf_id")} AS plan_id, shelf_id, CAST(suggested_qty AS INT) AS suggested_qty,
            'pending' AS status, {TS} AS created_at, {TS} AS updated_at FROM refill WHERE suggested_qty > 0""",
        "inventory", "shelf_events", "shelf_policies", **LEVEL_PARTS),
    "reorder_alerts": oracle(
        """SELECT 'supplier_request' AS event_type, shelf_id, 'warehouse' AS location, wh_current_stock AS current_stock, rop AS min_qty
           FROM wh_levels WHERE wh_current_stock < rop""", "inventory", "wh_events", "wh_policies", **WH_LEVEL_PARTS),
    "wh_alerts_with_cooldown": oracle(
        f"""SELECT * FROM (SELECT 'supplier_request' AS event_type, shelf_id, 'warehouse' AS location, wh_current_stock AS current_stock,
              rop AS min_qty, {_nulls}, 0 AS suggested_qty, {TS} AS created_at FROM wh_levels WHERE wh_current_stock < rop
            UNION ALL SELECT 'near_expiry', shelf_id, 'warehouse', CAST(qty_on_batches AS INT), CAST(NULL AS INT), CAST(NULL AS DOUBLE),
              CAST(NULL AS DOUBLE), 0, {TS} FROM near) a WHERE {_cool}""",
        "inventory", "wh_events", "wh_policies", "wh_lots", "recent_alerts", **WH_LEVEL_PARTS, near=_near(10)),
    "resolved_alerts": oracle(
        f"""SELECT shelf_id, 'warehouse' AS location, 'supplier_request' AS alert_event_type, 'resolved' AS status, {TS} AS "timestamp"
            FROM wh_levels WHERE wh_current_stock >= rop""", "inventory", "wh_events", "wh_policies", **WH_LEVEL_PARTS),
    "supplier_plan": oracle(
        f"""SELECT {uuid_sql("'supplier:1998-06-01 12:00:00:' || shelf_id")} AS supplier_plan_id, shelf_id,
            CAST(CASE WHEN bs IS NULL THEN gap ELSE CEIL(gap / (bs * 2.0)) * bs * 2 END AS INT) AS suggested_qty, bs AS standard_batch_size,
            'pending' AS status, {TS} AS created_at, {TS} AS updated_at
            FROM (SELECT w.shelf_id, w.rop - w.wh_current_stock AS gap, i.standard_batch_size AS bs FROM wh_levels w
                  LEFT JOIN (SELECT * FROM inventory WHERE item_category <> 'LARGE') i ON w.shelf_id = i.shelf_id WHERE w.wh_current_stock < w.rop)
            WHERE gap > 0""", "inventory", "wh_events", "wh_policies", **WH_LEVEL_PARTS),
    "alert_status": oracle(
        f"""SELECT b.alert_id, COALESCE(k.st, b.named_st, b.status) AS status,
            CASE WHEN COALESCE(k.st, b.named_st) IS NULL THEN b.created_at ELSE {TS} END AS updated_at
            FROM base b LEFT JOIN keyed k ON b.alert_id = k.alert_id AND k.rn = 1""",
        "alert_history", "status_changes", changes=_changes, named=_named, base=_base, keyed=_keyed),
    "fifo_allocation": oracle("SELECT * FROM fifo", "restock_plans", "wh_lots", **FIFO_PARTS),
    "fifo_allocation_per_plan": oracle(
        """SELECT p.plan_id, p.shelf_id, l.batch_code, l.received_date, l.expiry_date,
           CAST(LEAST(l.qty, p.suggested_qty - (l.s1 - l.qty)) AS INT) AS alloc_qty FROM mature p JOIN lot_line l ON p.shelf_id = l.shelf_id
           WHERE p.suggested_qty > l.s1 - l.qty""", "restock_plans", "wh_lots", mature=_mature, lot_line=_lot_line),
    "fefo_allocation": oracle("SELECT shelf_id, batch_code, expiry_date, take FROM fefo", "shelf_events", "wh_lots", sold=_sold, fefo=_fefo),
    "allocation_shortage": oracle(
        """SELECT m.plan_id, CAST(m.suggested_qty AS BIGINT) AS wanted, CAST(COALESCE(SUM(f.alloc_qty), 0) AS BIGINT) AS served,
           CAST(m.suggested_qty - COALESCE(SUM(f.alloc_qty), 0) AS BIGINT) AS missing FROM mature m LEFT JOIN fifo f ON m.plan_id = f.plan_id
           GROUP BY m.plan_id, m.suggested_qty""", "restock_plans", "wh_lots", **FIFO_PARTS),
    "lot_transfer": oracle(
        """SELECT l.shelf_id, l.batch_code, l.expiry_date, CAST(l.qty - COALESCE(f.take, 0) AS INT) AS batch_quantity_warehouse, 'source' AS side
           FROM wh_lots l LEFT JOIN fefo f ON l.shelf_id = f.shelf_id AND l.batch_code = f.batch_code WHERE l.qty - COALESCE(f.take, 0) > 0
           UNION ALL SELECT shelf_id, batch_code || '-T', expiry_date, CAST(take AS INT), 'destination' FROM fefo""",
        "shelf_events", "wh_lots", sold=_sold, fefo=_fefo),
    "split_into_batches": oracle(
        """SELECT shelf_id, CAST(n AS INT) AS batch_no, CAST(LEAST(standard_batch_size, current_stock - standard_batch_size * (n - 1)) AS INT) AS batch_qty
           FROM (SELECT *, UNNEST(range(1, CAST(CEIL(current_stock / standard_batch_size) AS BIGINT) + 1)) AS n FROM inventory WHERE current_stock > 0)""",
        "inventory"),
    "plan_issued": oracle(
        f"""SELECT plan_id, shelf_id, suggested_qty, CASE WHEN ready THEN 'issued' ELSE status END AS status, created_at,
            CASE WHEN ready THEN {TS} ELSE created_at END AS updated_at FROM (SELECT *, status = 'pending' AND created_at <= {TS} - INTERVAL '60' SECOND AS ready
            FROM restock_plans)""", "restock_plans"),
    "restock_wh_out": oracle(
        f"""SELECT {uuid_sql("'wh_out:' || plan_id || ':' || shelf_id || ':' || batch_code")} AS event_id, plan_id, shelf_id, batch_code,
            alloc_qty AS qty, {TS} AS "timestamp" FROM fifo""", "restock_plans", "wh_lots", **FIFO_PARTS),
    "restock_acks": oracle(
        "SELECT shelf_id, plan_id, 'ack' AS status, CAST(SUM(alloc_qty) AS BIGINT) AS moved FROM fifo GROUP BY shelf_id, plan_id",
        "restock_plans", "wh_lots", **FIFO_PARTS),
    "slot_apportionment": oracle(
        """SELECT day, event_type, CAST(total AS INT) AS total, CAST(fl + CASE WHEN ROW_NUMBER() OVER (PARTITION BY day ORDER BY rest DESC, event_type)
             <= total - SUM(fl) OVER (PARTITION BY day) THEN 1 ELSE 0 END AS BIGINT) AS share
           FROM (SELECT day, event_type, total, (total * weight) // base AS fl, (total * weight) % base AS rest FROM
             (SELECT *, CAST(SUM(n) OVER (PARTITION BY day) AS BIGINT) AS total, CAST(SUM(weight) OVER (PARTITION BY day) AS BIGINT) AS base FROM
               (SELECT CAST(ts AS DATE) AS day, event_type, CAST(SUM(CAST(value * 100 AS DECIMAL(12,0))) AS BIGINT) AS weight, COUNT(*) AS n
                FROM events GROUP BY 1, 2)))"""),
    "supplier_orders": oracle(
        f"""SELECT COALESCE(o.order_id, n.order_id) AS order_id, COALESCE(o.delivery_date, n.delivery_date) AS delivery_date,
            COALESCE(o.shelf_id, n.shelf_id) AS shelf_id,
            CAST(CASE WHEN o.order_id IS NULL THEN n.total_qty WHEN n.order_id IS NOT NULL AND o.status = 'issued' THEN o.total_qty + n.total_qty ELSE o.total_qty END AS INT) AS total_qty,
            COALESCE(o.status, 'issued') AS status,
            CASE WHEN n.order_id IS NOT NULL AND COALESCE(o.status, 'issued') = 'issued' THEN {TS} ELSE o.cutoff_ts END AS cutoff_ts,
            CASE WHEN n.order_id IS NOT NULL AND COALESCE(o.status, 'issued') = 'issued' THEN TIMESTAMP '1998-06-03 08:00:00' ELSE o.delivery_ts END AS delivery_ts,
            COALESCE(o.created_at, {TS}) AS created_at,
            CASE WHEN n.order_id IS NOT NULL AND COALESCE(o.status, 'issued') = 'issued' THEN {TS} ELSE o.updated_at END AS updated_at
            FROM supplier_orders o FULL JOIN n ON o.delivery_date = n.delivery_date AND o.shelf_id = n.shelf_id""",
        "supplier_orders", "supplier_plans", n=_new_orders),
    "supplier_cutoff_plans": oracle(
        f"""SELECT supplier_plan_id, CASE WHEN lower(trim(status)) = 'pending' THEN 'issued' ELSE lower(trim(status)) END AS status,
            CASE WHEN lower(trim(status)) = 'pending' THEN {TS} ELSE updated_at END AS updated_at FROM supplier_plans""", "supplier_plans"),
    "supplier_delivery": oracle(
        f"""SELECT 'wh_in' AS event_type, {uuid_sql("'wh_in:1998-06-01:' || shelf_id")} AS event_id, shelf_id,
            'SUP-19980601-' || shelf_id || '-1' AS batch_code, total_qty AS qty, {TS} AS "timestamp", {DAY} AS received_date,
            DATE '1999-06-01' AS expiry_date, 'supplier_delivery' AS reason FROM due""", "supplier_orders", "supplier_receipts", due=_due),
    "supplier_receipts": oracle(
        f"""SELECT receipt_id, delivery_date, shelf_id, received_qty, created_at FROM supplier_receipts UNION ALL
            SELECT {uuid_sql("'wh_supplier_receipt:1998-06-01:' || shelf_id")}, delivery_date, shelf_id, total_qty, {TS} FROM due""",
        "supplier_orders", "supplier_receipts", due=_due),
    "supplier_delivered_orders": oracle(
        f"""SELECT o.order_id, CASE WHEN d.order_id IS NULL THEN o.status ELSE 'delivered' END AS status,
            CASE WHEN d.order_id IS NULL THEN o.delivery_ts ELSE {TS} END AS delivery_ts,
            CASE WHEN d.order_id IS NULL THEN o.updated_at ELSE {TS} END AS updated_at
            FROM supplier_orders o LEFT JOIN due d ON o.order_id = d.order_id""", "supplier_orders", "supplier_receipts", due=_due),
    "supplier_completed_plans": oracle(
        f"""SELECT supplier_plan_id, CASE WHEN hit THEN 'completed' ELSE status END AS status, CASE WHEN hit THEN {TS} ELSE updated_at END AS updated_at
            FROM (SELECT *, lower(trim(status)) = 'issued' AND shelf_id IN (SELECT shelf_id FROM due) AS hit FROM supplier_plans)""",
        "supplier_orders", "supplier_receipts", "supplier_plans", due=_due),
    "next_delivery": oracle(
        f"""SELECT o_orderkey, MIN(d) AS delivery_date FROM (SELECT o_orderkey, ts, CAST(ts AS DATE) + CAST(k AS INT) AS d, k FROM
              (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS ts FROM orders) t
              CROSS JOIN range(0, 8) r(k)) WHERE {_dow} IN (0, 2, 4) AND (k > 0 OR ts < d + INTERVAL '8' HOUR) GROUP BY o_orderkey"""),
    "uuid5_ids": oracle(
        f"""SELECT shelf_id, {uuid_sql("'wh_in:1998-06-01:' || shelf_id || 'é'")} AS id,
            {uuid_mod_sql("'wh_in:1998-06-01:' || shelf_id || 'é'")} AS draw FROM inventory""", "inventory"),
    "order_quantity": oracle(
        """SELECT shelf_id, CAST(CASE WHEN fut < maximum_stock THEN LEAST(CEIL(GREATEST(0, CEIL(item_weight / 3 * 100 * 14) - fut) / standard_batch_size)
             * standard_batch_size, GREATEST(0, warehouse_capacity - fut)) ELSE 0 END AS BIGINT) AS order_qty
           FROM (SELECT *, current_stock + standard_batch_size AS fut FROM inventory)""", "inventory"),
    "capped_delivery": oracle(
        """SELECT i.shelf_id, CAST(LEAST(p.q, GREATEST(0, i.maximum_stock - i.current_stock)) AS BIGINT) AS delivered,
           CAST(p.q - LEAST(p.q, GREATEST(0, i.maximum_stock - i.current_stock)) AS BIGINT) AS carried_over
           FROM inventory i JOIN (SELECT shelf_id, SUM(suggested_qty) AS q FROM supplier_plans GROUP BY shelf_id) p ON i.shelf_id = p.shelf_id""",
        "inventory", "supplier_plans"),
}
