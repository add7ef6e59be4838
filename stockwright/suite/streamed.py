"""Jobs run as streams over the test tables until their input is used up; the final table is the result."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.align import align_to_schema
from ..plans.alerts import ALERT_KEY
from ..plans.inventory import add_deltas
from ..schemas import ALERT_FEED, ALERTS, FOOT_TRAFFIC, SHELF_STATE, WH_STATE
from ..sources.files import stream_files
from ..streaming import jobs as J
from ..streaming.runner import append_stream, changelog_table, read_keyed, run_stream
from ..workspace import new_folder
from .alerting import ORACLES as ALERTING, _cool, _near, uuid_sql
from .fixtures import Inputs, now_ts, oracle
from .loading import MAPPING, ORACLES as LOADING, named_rows
from .pricing import CART_ORDER, ORACLES as PRICING
from .state import LEVELS, ORACLES as STATE, POLICY_LATEST, REFILL, TS


def finish(query) -> None:
    query.awaitTermination()


def q_shelf(i: Inputs):
    """Running net change per shelf in update mode, published as a changelog."""
    root = new_folder(i.spark, "shelf-state")
    finish(J.shelf_delta_stream(i.stream("shelf_events", "lineitem"), f"{root}/log", f"{root}/progress"))
    deltas = changelog_table(i.spark.read.parquet(f"{root}/log"), ["shelf_id"]).where("delta is not null")
    weighted = deltas.join(i.profiles, "shelf_id", "left")
    return add_deltas(i.opening_shelf, weighted, "current_stock", now_ts(), {"item_weight": F.col("s.item_weight")})


def q_shelf_table(i: Inputs):
    """Shelf state kept as a versioned table, one version per batch."""
    root = new_folder(i.spark, "shelf-table")
    job = J.shelf_state_job(f"{root}/state", f"{root}/log", align_to_schema(i.opening_shelf, SHELF_STATE), i.profiles, now_ts())
    finish(run_stream(i.stream("shelf_events", "lineitem"), job, f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/state", SHELF_STATE, ["shelf_id"])


def q_wh(i: Inputs):
    root = new_folder(i.spark, "wh-state")
    job = J.raw_and(f"{root}/raw", "wh_events", J.wh_state_job(f"{root}/state", f"{root}/log", align_to_schema(i.opening_wh, WH_STATE), now_ts()))
    finish(run_stream(i.stream("wh_events", "lineitem"), job, f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/state", WH_STATE, ["shelf_id"])


def q_lots(i: Inputs):
    root = new_folder(i.spark, "lots")
    job = J.lot_events_job(f"{root}/wh", f"{root}/store", i.wh_lots, i.store_lots)
    finish(run_stream(i.stream("wh_events", "lineitem"), job, f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/store", i.store_lots.schema, J.LOT_KEY)


def q_refill(i: Inputs):
    root = new_folder(i.spark, "refill")
    job = J.delayed_refill_job(f"{root}/state", f"{root}/out", i.profiles)
    finish(run_stream(i.stream("wh_events", "lineitem"), job, f"{root}/progress"))
    return i.spark.read.parquet(f"{root}/out").select("event_id", "event_type", "shelf_id", "quantity", F.round("delta_weight", 6).alias("delta_weight"), "ts")


def q_cart(i: Inputs):
    root = new_folder(i.spark, "cart")
    finish(run_stream(i.stream("shelf_events", "lineitem"), J.cart_job(f"{root}/state", f"{root}/out", CART_ORDER), f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/state", J.CART_STATE, J.CART_KEY).select("customer_id", "item_id", "quantity")


def q_dedup(i: Inputs):
    """Events delivered twice."""
    root = new_folder(i.spark, "dedup")
    once = lambda: i.sql("SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts FROM events",
                         events=stream_files(i.spark, i.folder, i.table("events").schema, "events.parquet"))
    finish(append_stream(J.deduplicated(once().union(once()), "event_id", "ts", "24 hours"), f"{root}/out", f"{root}/progress"))
    return i.spark.read.parquet(f"{root}/out").select("event_id", "user_id", "ts")


def q_router(i: Inputs):
    root = new_folder(i.spark, "router")
    source = named_rows(stream_files(i.spark, i.folder, i.table("events").schema, "events.parquet"))
    finish(run_stream(source, J.router_job(f"{root}/topics", MAPPING), f"{root}/progress"))
    return i.spark.read.parquet(f"{root}/topics").select("topic", "key", "value")


def q_foot(i: Inputs):
    root = new_folder(i.spark, "visits")
    visits = align_to_schema(i.stream("visits", "events"), FOOT_TRAFFIC)
    finish(J.foot_traffic_stream(visits, f"{root}/raw", f"{root}/progress"))
    return i.spark.read.schema(FOOT_TRAFFIC).parquet(f"{root}/raw").select("customer_id", "entry_time", "exit_time", "trip_duration_minutes")


def q_cooldown(i: Inputs):
    """Every active alert of the history offered once; one alert per type and place passes for each arrival."""
    root = new_folder(i.spark, "cooldown")
    rows = i.stream("alert_history", "events").select("event_type", "shelf_id", "location", "alert_id", now_ts().alias("created_at"))
    finish(run_stream(rows, J.cooldown_job(f"{root}/state", f"{root}/out"), f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/state", J.COOLDOWN_STATE, ALERT_KEY)


def q_shelf_alerts(i: Inputs):
    """Shelf states arriving as a changelog raise alerts and plans."""
    root = new_folder(i.spark, "shelf-alerts")
    job = J.shelf_alert_job(f"{root}/out", lambda: i["shelf_policies"], lambda: i["inventory"], lambda: i.store_lots,
                            lambda: i["recent_alerts"], now_ts())
    finish(run_stream(i.stream("inventory", "part").select("shelf_id", "current_stock"), job, f"{root}/progress"))
    return i.spark.read.parquet(f"{root}/out/alerts").drop("app_id", "batch_id").withColumn("stock_pct", F.round("stock_pct", 6))


def q_wh_alerts(i: Inputs):
    root = new_folder(i.spark, "wh-alerts")
    job = J.wh_alert_job(f"{root}/out", lambda: i["wh_policies"], lambda: i.wh_lots,
                         lambda: i["inventory"].select("shelf_id", "standard_batch_size"), lambda: i["recent_alerts"], now_ts())
    state = i.stream("inventory", "part").select("shelf_id", (F.col("current_stock") / 5).cast("int").alias("wh_current_stock"))
    finish(run_stream(state, job, f"{root}/progress"))
    return i.spark.read.parquet(f"{root}/out/plans").select("supplier_plan_id", "shelf_id", "suggested_qty", "standard_batch_size", "status")


def q_restock(i: Inputs):
    root = new_folder(i.spark, "restock")
    job = J.restock_job(f"{root}/state", f"{root}/out", lambda: i.wh_lots, now_ts())
    finish(run_stream(i.stream("restock_plans", "part").withColumn("updated_at", F.col("created_at")), job, f"{root}/progress"))
    return i.spark.read.parquet(f"{root}/out/wh_out").select("event_id", "plan_id", "shelf_id", "batch_code", "qty", "timestamp")


def q_alert_sink(i: Inputs):
    """Status changes arriving as a stream on a table of alerts."""
    root = new_folder(i.spark, "alert-sink")
    opening = align_to_schema(i["alert_history"].withColumn("updated_at", F.col("created_at")), ALERTS)
    changes = i.stream("status_changes", "events").withColumn("event_type", F.lit("alert_status_change"))
    none = {f.name: F.lit(None).cast(f.dataType) for f in ALERT_FEED if f.name not in changes.columns}
    job = J.alert_sink_job(f"{root}/state", opening, now_ts())
    finish(run_stream(changes.withColumns(none), job, f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/state", ALERTS, ["alert_id"]).select("alert_id", "status", "updated_at")


def q_lot_sales(i: Inputs):
    root = new_folder(i.spark, "lot-sales")
    lines = i.stream("receipt_lines", "lineitem").where("batch_code is not null")
    finish(run_stream(lines, J.store_lot_sales_job(f"{root}/state", i.store_lots), f"{root}/progress"))
    return read_keyed(i.spark, f"{root}/state", i.store_lots.schema, J.LOT_KEY).select("shelf_id", "batch_code", "batch_quantity_store", "last_update_ts")


QUERIES = {
    "stream_lot_sales": q_lot_sales,
    "stream_shelf_alerts": q_shelf_alerts,
    "stream_wh_alerts": q_wh_alerts,
    "stream_restock": q_restock,
    "stream_alert_sink": q_alert_sink,
    "stream_shelf_state": q_shelf,
    "stream_shelf_table": q_shelf_table,
    "stream_wh_state": q_wh,
    "stream_store_lots": q_lots,
    "stream_delayed_refill": q_refill,
    "stream_cart": q_cart,
    "stream_dedup": q_dedup,
    "stream_router": q_router,
    "stream_foot_traffic": q_foot,
    "stream_alert_cooldown": q_cooldown,
}

_due = """SELECT e.*, i.item_weight FROM wh_events e LEFT JOIN inventory i ON e.shelf_id = i.shelf_id
  WHERE event_type = 'wh_out' AND qty > 0 AND ts + INTERVAL '3' MINUTE <= (SELECT MAX(ts) FROM wh_events)"""

_levels = LEVELS.replace("FROM state s JOIN", "FROM inventory s JOIN").replace("FROM state s LEFT JOIN", "FROM inventory s LEFT JOIN")

ORACLES = {
    "stream_lot_sales": STATE["lot_state_from_sales"],
    "stream_shelf_alerts": oracle(
        f"""SELECT * FROM (SELECT 'refill_request' AS event_type, shelf_id, 'store' AS location, current_stock, min_qty, threshold_pct,
              ROUND(stock_pct, 6) AS stock_pct, CAST(suggested_qty AS INT) AS suggested_qty, {TS} AS created_at FROM refill
            UNION ALL SELECT 'near_expiry', shelf_id, 'store', CAST(qty_on_batches AS INT), CAST(NULL AS INT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 0, {TS}
            FROM near) a WHERE {_cool}""",
        "inventory", "shelf_policies", "wh_lots", "recent_alerts", policy=POLICY_LATEST, levels=_levels, refill=REFILL, near=_near(5)),
    "stream_wh_alerts": oracle(
        f"""SELECT {uuid_sql("'supplier:1998-06-01 12:00:00:' || shelf_id")} AS supplier_plan_id, shelf_id,
            CAST(CEIL(gap / (bs * 1.0)) * bs AS INT) AS suggested_qty, bs AS standard_batch_size, 'pending' AS status FROM
            (SELECT i.shelf_id, i.standard_batch_size AS bs, COALESCE(p.reorder_point_qty, 10) - i.current_stock // 5 AS gap FROM inventory i
             LEFT JOIN (SELECT * FROM wh_policies WHERE active) p ON i.shelf_id = p.shelf_id) WHERE gap > 0""", "inventory", "wh_policies"),
    "stream_restock": ALERTING["restock_wh_out"],
    "stream_alert_sink": ALERTING["alert_status"],
    "stream_shelf_state": STATE["shelf_state"],
    "stream_shelf_table": STATE["shelf_state"],
    "stream_wh_state": STATE["wh_state"],
    "stream_store_lots": STATE["store_lot_state"],
    "stream_delayed_refill": oracle(
        """SELECT event_id, 'putback' AS event_type, shelf_id, qty AS quantity, CAST(NULL AS DOUBLE) AS delta_weight, ts FROM due
           UNION ALL SELECT event_id, 'weight_change', shelf_id, NULL, ROUND(item_weight * qty, 6), ts FROM due""", "wh_events", "inventory", due=_due),
    "stream_cart": PRICING["cart_state"],
    "stream_dedup": "SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts FROM events",
    "stream_router": LOADING["stream_routing"],
    "stream_foot_traffic": oracle("SELECT customer_id, entry_time, exit_time, trip_duration_minutes FROM visits", "visits"),
    "stream_alert_cooldown": oracle("SELECT DISTINCT event_type, shelf_id, location, TIMESTAMP '1998-06-01 12:00:00' AS created_at FROM alert_history", "alert_history"),
}
