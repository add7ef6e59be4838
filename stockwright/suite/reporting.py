"""Queries behind the operational reports."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.align import backfill
from ..operators.latest import dedupe_events
from ..plans import alerts as A, reports as R
from ..plans.config import batch_sizes
from .fixtures import VISIT_NOW, Inputs, now_ts, oracle, visit_now
from .alerting import uuid_sql
from .state import TS

VTS = f"TIMESTAMP '{VISIT_NOW}'"


def q_last_restock(i: Inputs):
    return R.restock_day(i["wh_events"]).select("restock_day", "restock_ts", F.col("items").alias("items"), "shelves")


def q_order_dates(i: Inputs):
    return R.order_dates(i["supplier_orders"], now_ts())


def q_topk(i: Inputs):
    return R.topk(i["alert_history"], [F.desc("created_at"), "alert_id"], 100)


def q_dedup(i: Inputs):
    """Warehouse events repeat their id; rows received without one are told apart by their values."""
    e = i["wh_events"].withColumn("event_id", F.when(F.col("event_type") == "wh_in", F.col("event_id")).otherwise(""))
    return dedupe_events(e, "event_id", ["event_type", "shelf_id", "batch_code", "qty", "ts"], ["ts", "qty", "shelf_id", "batch_code"]).select(
        "event_id", "event_type", "shelf_id", "batch_code", "qty", "ts")


def q_backfill(i: Inputs):
    plans = i["supplier_plans"].withColumn("standard_batch_size", F.when(F.col("status") == "issued", F.col("standard_batch_size")))
    return backfill(plans, batch_sizes(i["inventory"]), "shelf_id", "standard_batch_size").select("supplier_plan_id", "standard_batch_size")


def q_filtered(i: Inputs):
    j = R.with_category(i["supplier_plans"], i["inventory"])
    return R.narrow(j, category=" promo ", status="issued").select("supplier_plan_id", "shelf_id", "item_category", "suggested_qty")


def q_narrowed(i: Inputs):
    """Feature rows of a category between two days, and those of one shelf; criteria on columns that are not there do not narrow."""
    rows = i["feature_rows"].select("shelf_id", "feature_date", "item_category", "sales_qty")
    first, last = (F.lit(d).cast("date") for d in ("1996-01-01", "1997-12-31"))
    some = R.narrow(rows, category=" promo ", since=first, until=last, model="any", status="any")
    return some.withColumn("by", F.lit("category")).union(R.narrow(rows, shelf="S7").withColumn("by", F.lit("shelf")))


def q_recent(i: Inputs):
    return R.recent_rows(i["visits"].select("customer_id", F.col("entry_time").alias("event_time"), "event_id"), 50)


def q_new_alerts(i: Inputs):
    """The feed split into new alerts, in the shape of the alert table, and status changes."""
    feed = i["alert_history"].withColumn("event_type", F.when(F.col("status") == "ack", "alert_status_change").otherwise(F.col("event_type")))
    none = {"current_stock": "int", "threshold_pct": "double", "suggested_qty": "int"}
    new, changes = A.split_alert_feed(feed.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}))
    rows = A.alert_rows(new, now_ts()).select("alert_id", "event_type", "shelf_id", "location", "status", "created_at", "updated_at")
    return rows.unionByName(changes.select("event_type", "shelf_id", "location", "status", "created_at"), allowMissingColumns=True)


QUERIES = {
    "alert_feed": q_new_alerts,
    "people_per_day": lambda i: R.people_on(i["feature_rows"].withColumn("people_count", F.col("sales_qty")), F.lit("1998-06-01").cast("date")),
    "live_occupancy": lambda i: R.occupancy(i["visits"], visit_now()),
    "active_alerts": lambda i: R.active_alerts(i["alert_history"]).select("alert_id", "shelf_id", "status", "place"),
    "alert_places": lambda i: R.alerts_by_place(i["alert_history"]),
    "alert_categories": lambda i: R.store_alerts_by_category(i["alert_history"], i["inventory"]),
    "red_categories": lambda i: R.red_categories(i["alert_history"], i["inventory"]),
    "last_restock_day": q_last_restock,
    "last_restock_rows": lambda i: R.restock_rows(i["wh_events"]).select("event_id", "shelf_id", "batch_code", "qty", "ts"),
    "order_dates": q_order_dates,
    "topk_alerts": q_topk,
    "recent_visits": q_recent,
    "distinct_categories": lambda i: R.distinct_values(i["inventory"], "item_category"),
    "dedup_events": q_dedup,
    "entry_exit_rows": lambda i: R.entry_exit(i["visits"]),
    "batch_size_backfill": q_backfill,
    "filtered_plans": q_filtered,
    "filtered_features": q_narrowed,
}

_store = "(lower(trim(location)) LIKE '%store%' OR lower(trim(location)) LIKE '%shop%')"
_place = f"CASE WHEN {_store} THEN 'store' WHEN lower(trim(location)) LIKE '%warehouse%' OR lower(trim(location)) LIKE 'wh%' THEN 'warehouse' ELSE 'other' END"
_active = f"SELECT *, {_place} AS place FROM alert_history WHERE lower(trim(status)) IN ('open', 'active', 'pending')"
_last = "SELECT MAX(CAST(ts AS DATE)) FROM wh_events WHERE event_type = 'wh_in'"
_slot = """CASE WHEN hour(entry_time) >= 20 THEN '20:00–23:59' WHEN hour(entry_time) >= 17 THEN '17:00–19:59' WHEN hour(entry_time) >= 14 THEN '14:00–16:59'
  WHEN hour(entry_time) >= 10 THEN '10:00–13:59' WHEN hour(entry_time) >= 7 THEN '07:00–09:59' ELSE '00:00–06:59' END"""

ORACLES = {
    "alert_feed": oracle(
        f"""SELECT {uuid_sql("'alert:' || strftime(created_at, '%Y-%m-%d %H:%M:%S.') || rtrim(strftime(created_at, '%f'), '0') || ':' || location || ':' || event_type || ':' || shelf_id")} AS alert_id,
            event_type, shelf_id, location, 'open' AS status, created_at, {TS} AS updated_at FROM alert_history WHERE status <> 'ack'
            UNION ALL SELECT NULL, 'alert_status_change', shelf_id, location, status, created_at, NULL FROM alert_history WHERE status = 'ack'""", "alert_history"),
    "people_per_day": oracle(
        "SELECT feature_date, MAX(sales_qty) AS people_count FROM feature_rows WHERE feature_date = DATE '1998-06-01' GROUP BY feature_date", "feature_rows"),
    "live_occupancy": oracle(
        f"""SELECT COUNT(*) AS inside FROM visits WHERE entry_time BETWEEN {VTS} - INTERVAL '1' DAY AND {VTS} AND (exit_time IS NULL OR exit_time > {VTS})""", "visits"),
    "active_alerts": oracle("SELECT alert_id, shelf_id, status, place FROM active", "alert_history", active=_active),
    "alert_places": oracle("SELECT place, COUNT(*) AS alerts, COUNT(DISTINCT shelf_id) AS shelves FROM active GROUP BY place", "alert_history", active=_active),
    "alert_categories": oracle(
        """SELECT upper(trim(i.item_category)) AS item_category, a.shelf_id, a.n AS alerts FROM (SELECT shelf_id, COUNT(*) AS n FROM active
           WHERE place = 'store' GROUP BY shelf_id) a LEFT JOIN inventory i ON a.shelf_id = i.shelf_id""", "alert_history", "inventory", active=_active),
    "red_categories": oracle(
        "SELECT DISTINCT upper(trim(i.item_category)) AS item_category FROM active a JOIN inventory i ON a.shelf_id = i.shelf_id WHERE place = 'store'",
        "alert_history", "inventory", active=_active),
    "last_restock_day": oracle(
        f"""SELECT MAX(CAST(ts AS DATE)) AS restock_day, MAX(ts) AS restock_ts, CAST(SUM(qty) AS BIGINT) AS items, COUNT(DISTINCT shelf_id) AS shelves
            FROM wh_events WHERE event_type = 'wh_in' AND CAST(ts AS DATE) = ({_last})""", "wh_events"),
    "last_restock_rows": oracle(
        f"SELECT event_id, shelf_id, batch_code, qty, ts FROM wh_events WHERE event_type = 'wh_in' AND CAST(ts AS DATE) = ({_last})", "wh_events"),
    "order_dates": oracle(
        f"""SELECT MIN(CASE WHEN delivery_ts >= {TS} THEN delivery_ts END) AS next_order, MAX(delivery_ts) AS last_order, 'delivery_ts' AS source
            FROM supplier_orders WHERE lower(trim(status)) NOT IN ('canceled', 'cancelled')""", "supplier_orders"),
    "topk_alerts": oracle("SELECT * FROM alert_history ORDER BY created_at DESC, alert_id LIMIT 100", "alert_history"),
    "recent_visits": oracle("SELECT customer_id, entry_time AS event_time, event_id FROM visits ORDER BY event_time DESC, customer_id, event_id LIMIT 50", "visits"),
    "distinct_categories": oracle("SELECT DISTINCT item_category FROM inventory", "inventory"),
    "dedup_events": oracle(
        """SELECT event_id, event_type, shelf_id, batch_code, qty, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts DESC, qty DESC, shelf_id DESC, batch_code DESC) AS rn
             FROM wh_events WHERE event_type = 'wh_in') WHERE rn = 1
           UNION ALL SELECT DISTINCT '', event_type, shelf_id, batch_code, qty, ts FROM wh_events WHERE event_type = 'wh_out'""", "wh_events"),
    "entry_exit_rows": oracle(
        f"""SELECT 'entry' AS event_type, customer_id, entry_time AS "time", dayname(entry_time) AS weekday, {_slot} AS time_slot FROM visits
            UNION ALL SELECT 'exit', customer_id, exit_time, dayname(entry_time), {_slot} FROM visits WHERE exit_time IS NOT NULL""", "visits"),
    "batch_size_backfill": oracle(
        """SELECT p.supplier_plan_id, COALESCE(CASE WHEN p.status = 'issued' THEN p.standard_batch_size END, i.standard_batch_size) AS standard_batch_size
           FROM supplier_plans p LEFT JOIN inventory i ON p.shelf_id = i.shelf_id""", "supplier_plans", "inventory"),
    "filtered_features": oracle(
        """SELECT shelf_id, feature_date, item_category, sales_qty, 'category' AS by FROM feature_rows
           WHERE item_category = 'PROMO' AND feature_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
           UNION ALL SELECT shelf_id, feature_date, item_category, sales_qty, 'shelf' FROM feature_rows WHERE shelf_id = 'S7'""", "feature_rows"),
    "filtered_plans": oracle(
        """SELECT p.supplier_plan_id, p.shelf_id, i.item_category, p.suggested_qty FROM supplier_plans p JOIN inventory i ON p.shelf_id = i.shelf_id
           WHERE i.item_category = 'PROMO' AND p.status = 'issued'""", "supplier_plans", "inventory"),
}
