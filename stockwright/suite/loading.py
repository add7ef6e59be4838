"""Queries over configuration, mirroring, decoding and routing."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import compound_key
from ..operators.align import align_to_schema
from ..operators.merge import delete_keys, keep_newer, replace_rows
from ..plans import config as C
from ..plans.routing import mirror, route
from ..schemas import WH_EVENTS, columns
from ..sources.files import changelog_snapshot, incremental
from ..sources.messages import decode, encode
from .fixtures import Inputs, now_ts, oracle
from .state import TS

SNAPSHOTS = "CASE WHEN item_category = 'ECONOMY' THEN TIMESTAMP '1998-05-01 00:00:00' ELSE TIMESTAMP '1998-05-31 00:00:00' END AS snapshot_ts"


def snapshot(i: Inputs):
    """Inventory of two snapshot times."""
    return i["inventory"].withColumn(
        "snapshot_ts", F.when(F.col("item_category") == "ECONOMY", F.lit("1998-05-01")).otherwise(F.lit("1998-05-31")).cast("timestamp"))


def lot_snapshot(i: Inputs, days: int):
    lots = i["wh_lots"].withColumn("snapshot_ts", F.date_trunc("month", F.col("received_date").cast("timestamp")))
    return lots.select("snapshot_ts", "batch_code", "shelf_id", F.date_add("expiry_date", days).alias("expiry_date"),
                       (F.col("qty") % 7).cast("int").alias("standard_batch_size"))


def q_catalog(i: Inputs):
    return C.batch_catalog(lot_snapshot(i, 0), lot_snapshot(i, 10))


def q_default_policies(i: Inputs):
    known = i["shelf_policies"].where("shelf_id is not null").select("shelf_id", F.lit("x").alias("item_category"), F.lit("y").alias("item_subcategory"))
    return C.default_shelf_policies(snapshot(i), known)


def q_reorder(i: Inputs):
    warehouse = snapshot(i).withColumn("maximum_stock", F.when(F.col("standard_batch_size") > 6, F.col("warehouse_capacity") + 10))
    return C.default_wh_policies(warehouse, i["wh_policies"]).select("shelf_id", "item_category", "reorder_point_qty", "active")


def q_incremental(i: Inputs):
    return incremental(i["wh_events"].select("event_id", "shelf_id", "qty", "ts"), "ts", now_ts())[0]


def q_incremental_mark(i: Inputs):
    return incremental(i["wh_events"], "ts", now_ts())[1]


def q_align(i: Inputs):
    """Old column names, text numbers and missing columns fitted to one schema."""
    old = i["supplier_orders"].select(
        "order_id", F.col("total_qty").cast("string").alias("suggested_qty"), F.concat(F.lit(" "), F.col("shelf_id")).alias("shelf_id"),
        F.col("delivery_date").cast("string").alias("delivery_date"), "status", "cutoff_ts", F.lit(1).alias("odd"))
    target = columns("order_id string, delivery_date date, shelf_id string, total_qty bigint, status string, cutoff_ts timestamp, updated_at timestamp")
    return align_to_schema(old, target, {"total_qty": ("suggested_qty",)})


def q_changelog(i: Inputs):
    log = i["wh_events"].withColumn("_deleted", F.col("qty") == 1)
    return changelog_snapshot(log, ["shelf_id"], ["ts", "event_id", "batch_code", "qty"]).select("shelf_id", "event_id", "qty", "ts")


def q_mirror(i: Inputs):
    table = i["inventory"].select("shelf_id", "current_stock", "item_category")
    log = i["receipt_lines"].select(F.col("item_id").alias("shelf_id"), F.col("quantity").alias("current_stock"), "transaction_id", "ts", "batch_code",
                                    F.lit("hidden").alias("item_category"))
    return mirror(table, log, ["shelf_id"], ["ts", "transaction_id", "current_stock", "batch_code"], columns=["current_stock"])


def messages(i: Inputs):
    e = i["wh_events"].select("event_type", "event_id", "shelf_id", "batch_code", "qty",
                              F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("timestamp"),
                              F.col("received_date").cast("string").alias("received_date"))
    body = F.to_json(F.struct(*e.columns))
    # Some messages are damaged on the way and cannot be read.
    damaged = F.when(F.col("qty") % 8 == 0, F.concat(F.lit("?"), body)).otherwise(body)
    return e.select(F.lit(None).cast("string").alias("key"), damaged.alias("value"))


def q_decode(i: Inputs):
    return decode(messages(i), WH_EVENTS, not_null=["shelf_id", "qty", "timestamp"]).select(
        "event_type", "event_id", "shelf_id", "batch_code", "qty", "timestamp", "received_date")


def q_encode(i: Inputs):
    lots = i["wh_lots"].select("shelf_id", "batch_code", "qty")
    return encode(lots, ["shelf_id", "batch_code"], rename={"qty": "batch_quantity_store"})


MAPPING = {"view": "shelf_events", "purchase": "pos_transactions", "click": "foot_traffic"}


def named_rows(events):
    return events.select(F.col("event_type").alias("stream"), F.col("user_id").cast("string").alias("key"),
                         F.when(F.col("event_id") % 10 != 0, F.col("props")).alias("value"))


def q_replace(i: Inputs):
    fresh = i["supplier_plans"].groupBy("shelf_id").agg(F.sum("suggested_qty").cast("int").alias("current_stock"))
    return replace_rows(i["inventory"].select("shelf_id", "current_stock"), fresh, ["shelf_id"])


def q_products(i: Inputs):
    store = i["inventory"].select("shelf_id", "item_category", "maximum_stock")
    sizes = i["inventory"].where("standard_batch_size > 8").select("shelf_id", "standard_batch_size")
    return C.products(store, i["inventory"].where("item_category <> 'SMALL'"), sizes)


def q_newer(i: Inputs):
    sold = i["receipt_lines"].groupBy(F.col("item_id").alias("shelf_id")).agg(F.sum("quantity").cast("int").alias("current_stock"), F.max("ts").alias("last_update_ts"))
    base = i["inventory"].where("item_category <> 'SMALL'").select("shelf_id", "current_stock", F.lit("2001-06-01").cast("timestamp").alias("last_update_ts"))
    return keep_newer(base, sold, ["shelf_id"], "last_update_ts")


QUERIES = {
    "keep_newer": q_newer,
    "shelf_profiles": lambda i: C.shelf_profiles(snapshot(i)),
    "batch_catalog": q_catalog,
    "batch_sizes": lambda i: C.batch_sizes(lot_snapshot(i, 0), i["inventory"]),
    "default_policies": q_default_policies,
    "reorder_points": q_reorder,
    "products": q_products,
    "incremental_extract": q_incremental,
    "incremental_mark": q_incremental_mark,
    "schema_align": q_align,
    "changelog_snapshot": q_changelog,
    "table_mirror": q_mirror,
    "json_decode": q_decode,
    "json_encode": q_encode,
    "stream_routing": lambda i: route(named_rows(i.table("events")), MAPPING),
    "replace_by_key": q_replace,
    "delete_by_key": lambda i: delete_keys(i["inventory"].select("shelf_id", "item_category"), i["supplier_receipts"], ["shelf_id"]),
    "lot_keys": lambda i: i["wh_lots"].select(compound_key("shelf_id", "batch_code").alias("k"), compound_key("shelf_id", "batch_code", sep="|").alias("j")),
}


_lots = """SELECT date_trunc('month', received_date) AS snapshot_ts, batch_code, shelf_id, expiry_date + 0 AS expiry_date, CAST(qty % 7 AS INT) AS bs FROM wh_lots
  UNION ALL SELECT date_trunc('month', received_date), batch_code, shelf_id, expiry_date + 10, CAST(qty % 7 AS INT) FROM wh_lots"""

ORACLES = {
    "keep_newer": oracle(
        """SELECT COALESCE(b.shelf_id, s.item_id) AS shelf_id, COALESCE(s.q, b.current_stock) AS current_stock,
           CASE WHEN b.shelf_id IS NULL THEN s.ts ELSE GREATEST(s.ts, TIMESTAMP '2001-06-01 00:00:00') END AS last_update_ts
           FROM (SELECT * FROM inventory WHERE item_category <> 'SMALL') b FULL JOIN
           (SELECT item_id, CAST(SUM(quantity) AS INT) AS q, MAX(ts) AS ts FROM receipt_lines GROUP BY item_id) s ON b.shelf_id = s.item_id""",
        "inventory", "receipt_lines"),
    "shelf_profiles": oracle(
        f"SELECT shelf_id, MAX(item_weight) AS item_weight FROM s WHERE snapshot_ts = (SELECT MAX(snapshot_ts) FROM s) GROUP BY shelf_id",
        "inventory", s=f"SELECT *, {SNAPSHOTS} FROM inventory"),
    "batch_catalog": oracle(
        """SELECT batch_code, shelf_id, MAX(expiry_date) AS expiry_date, MAX(bs) AS standard_batch_size FROM l
           WHERE snapshot_ts = (SELECT MAX(snapshot_ts) FROM l) GROUP BY batch_code, shelf_id""", "wh_lots", l=_lots),
    "batch_sizes": oracle(
        """SELECT shelf_id, MAX(bs) AS standard_batch_size FROM (SELECT shelf_id, CAST(qty % 7 AS INT) AS bs FROM wh_lots UNION ALL
           SELECT shelf_id, standard_batch_size FROM inventory) WHERE bs > 0 GROUP BY shelf_id""", "wh_lots", "inventory"),
    "default_policies": oracle(
        f"""SELECT shelf_id, item_category, item_subcategory, CAST(30 AS DOUBLE) AS threshold_pct, 1 AS min_qty, TRUE AS active FROM s
            WHERE snapshot_ts = (SELECT MAX(snapshot_ts) FROM s) AND shelf_id NOT IN (SELECT shelf_id FROM shelf_policies WHERE shelf_id IS NOT NULL)
            UNION ALL SELECT NULL, NULL, NULL, 30, 1, TRUE""", "inventory", "shelf_policies", s=f"SELECT *, {SNAPSHOTS} FROM inventory"),
    "reorder_points": oracle(
        """SELECT shelf_id, item_category, CAST(GREATEST(1, ROUND(CAST(COALESCE(CASE WHEN standard_batch_size > 6 THEN warehouse_capacity + 10 END, current_stock) AS DECIMAL(18,0)) * 0.05)) AS INT) AS reorder_point_qty,
           TRUE AS active FROM s WHERE snapshot_ts = (SELECT MAX(snapshot_ts) FROM s) AND shelf_id NOT IN (SELECT shelf_id FROM wh_policies)""",
        "inventory", "wh_policies", s=f"SELECT *, {SNAPSHOTS} FROM inventory"),
    "products": oracle(
        """SELECT shelf_id, item_category, maximum_stock, CASE WHEN item_category <> 'SMALL' THEN maximum_stock ELSE 0 END AS warehouse_capacity,
           CASE WHEN item_category <> 'SMALL' THEN current_stock ELSE 0 END AS stock_warehouse,
           CASE WHEN standard_batch_size > 8 THEN standard_batch_size ELSE 24 END AS standard_batch_size FROM inventory""", "inventory"),
    "incremental_extract": oracle(f"SELECT event_id, shelf_id, qty, ts FROM wh_events WHERE ts > {TS}", "wh_events"),
    "incremental_mark": oracle(f"SELECT COALESCE(MAX(ts), {TS}) AS next_mark FROM wh_events WHERE ts > {TS}", "wh_events"),
    "schema_align": oracle(
        """SELECT order_id, delivery_date, ' ' || shelf_id AS shelf_id, CAST(total_qty AS BIGINT) AS total_qty, status, cutoff_ts, CAST(NULL AS TIMESTAMP) AS updated_at
           FROM supplier_orders""", "supplier_orders"),
    "changelog_snapshot": oracle(
        """SELECT shelf_id, event_id, qty, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shelf_id ORDER BY ts DESC, event_id DESC, batch_code DESC, qty DESC) AS rn
           FROM wh_events) WHERE rn = 1 AND qty <> 1""", "wh_events"),
    "table_mirror": oracle(
        """SELECT COALESCE(r.item_id, i.shelf_id) AS shelf_id, COALESCE(r.quantity, i.current_stock) AS current_stock, CASE WHEN r.item_id IS NULL THEN i.item_category END AS item_category
           FROM inventory i FULL JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY ts DESC, transaction_id DESC, quantity DESC,
             batch_code DESC NULLS LAST) AS rn FROM receipt_lines) WHERE rn = 1) r ON i.shelf_id = r.item_id""", "inventory", "receipt_lines"),
    "json_decode": oracle(
        """SELECT event_type, event_id, shelf_id, batch_code, qty, ts AS "timestamp", received_date FROM wh_events WHERE qty % 8 <> 0""", "wh_events"),
    "json_encode": oracle(
        """SELECT shelf_id || '::' || batch_code AS key, '{"shelf_id":"' || shelf_id || '","batch_code":"' || batch_code || '","batch_quantity_store":' || qty || '}' AS value
           FROM wh_lots""", "wh_lots"),
    "stream_routing": oracle(
        """SELECT CASE event_type WHEN 'view' THEN 'shelf_events' WHEN 'purchase' THEN 'pos_transactions' ELSE 'foot_traffic' END AS topic,
           CAST(user_id AS STRING) AS key, props AS value FROM events WHERE event_type IN ('view', 'purchase', 'click') AND event_id % 10 <> 0"""),
    "replace_by_key": oracle(
        """SELECT COALESCE(f.shelf_id, i.shelf_id) AS shelf_id, CAST(COALESCE(f.q, i.current_stock) AS INT) AS current_stock FROM inventory i FULL JOIN
           (SELECT shelf_id, SUM(suggested_qty) AS q FROM supplier_plans GROUP BY shelf_id) f ON i.shelf_id = f.shelf_id""", "inventory", "supplier_plans"),
    "delete_by_key": oracle("SELECT shelf_id, item_category FROM inventory WHERE shelf_id NOT IN (SELECT shelf_id FROM supplier_receipts)", "inventory", "supplier_receipts"),
    "lot_keys": oracle("SELECT shelf_id || '::' || batch_code AS k, shelf_id || '|' || batch_code AS j FROM wh_lots", "wh_lots"),
}
