"""The one registry of table and message schemas. Readers cast to these at the edges.

Times on the wire are text (see WIRE); in tables they are timestamps.
"""
from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def columns(text: str) -> T.StructType:
    """Schema from "name type, name type"; unlike a DDL string it needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in text.split(","))])


_s = columns


SHELF_EVENTS = _s(
    "event_type string, customer_id string, item_id string, shelf_id string, quantity int, "
    "weight double, delta_weight double, timestamp timestamp"
)
POS_ITEM = _s(
    "item_id string, batch_code string, quantity int, unit_price double, discount double, total_price double, "
    "expiry_date string"
)
POS_TRANSACTIONS = _s("event_type string, transaction_id string, customer_id string, timestamp timestamp").add(
    "items", T.ArrayType(POS_ITEM)
)
FOOT_TRAFFIC = _s(
    "event_type string, customer_id string, entry_time timestamp, exit_time timestamp, "
    "trip_duration_minutes int, weekday string, time_slot string"
)
WH_EVENTS = _s(
    "event_type string, event_id string, plan_id string, shelf_id string, batch_code string, qty int, "
    "unit string, timestamp timestamp, fifo boolean, received_date date, expiry_date date, "
    "batch_quantity_warehouse_after int, batch_quantity_store_after int, shelf_warehouse_qty_after int, reason string"
)
SHELF_STATE = _s("shelf_id string, current_stock int, item_weight double, last_update_ts timestamp")
WH_STATE = _s("shelf_id string, wh_current_stock int, last_update_ts timestamp")
SHELF_BATCH_STATE = _s(
    "shelf_id string, batch_code string, received_date date, expiry_date date, "
    "batch_quantity_store int, last_update_ts timestamp"
)
WH_BATCH_STATE = _s(
    "shelf_id string, batch_code string, received_date date, expiry_date date, "
    "batch_quantity_warehouse int, batch_quantity_store int, last_update_ts timestamp"
)
ALERT_FEED = _s(
    "event_type string, shelf_id string, location string, current_stock int, min_qty int, threshold_pct double, "
    "stock_pct double, suggested_qty int, created_at timestamp, alert_id string, status string, "
    "timestamp timestamp, alert_event_type string"
)
ALERTS = _s(
    "alert_id string, event_type string, shelf_id string, location string, current_stock int, max_stock int, "
    "target_pct double, suggested_qty int, status string, created_at timestamp, updated_at timestamp"
)
PRODUCT_TOTAL_STATE = _s("shelf_id string, total_stock int, last_update_ts timestamp")
SHELF_POLICIES = _s(
    "policy_id string, shelf_id string, item_category string, item_subcategory string, threshold_pct double, "
    "min_qty int, active boolean, notes string, updated_at timestamp"
)
WH_POLICIES = _s(
    "policy_id string, shelf_id string, item_category string, item_subcategory string, reorder_point_qty int, "
    "active boolean, notes string, updated_at timestamp"
)
SHELF_PROFILES = _s("shelf_id string, item_weight double")
RESTOCK_PLAN = _s(
    "plan_id string, shelf_id string, suggested_qty int, status string, created_at timestamp, updated_at timestamp"
)
SUPPLIER_PLAN = _s(
    "supplier_plan_id string, shelf_id string, suggested_qty int, standard_batch_size int, status string, "
    "created_at timestamp, updated_at timestamp"
)
SUPPLIER_ORDERS = _s(
    "order_id string, delivery_date date, shelf_id string, total_qty int, status string, cutoff_ts timestamp, "
    "delivery_ts timestamp, created_at timestamp, updated_at timestamp"
)
SUPPLIER_RECEIPTS = _s("receipt_id string, delivery_date date, shelf_id string, received_qty int, created_at timestamp")
DAILY_DISCOUNTS = _s("shelf_id string, discount_date date, discount double, created_at timestamp")
WEEKLY_DISCOUNTS = _s(
    "week_index int, week_start date, week_end date, shelf_id string, discount_pct double, "
    "original_price double, discounted_price double"
)
STORE_INVENTORY = _s(
    "shelf_id string, aisle int, item_weight double, shelf_weight double, item_category string, "
    "item_subcategory string, item_visibility double, maximum_stock int, current_stock int, item_price double"
)
WAREHOUSE_INVENTORY = _s(
    "shelf_id string, aisle int, item_weight double, shelf_weight double, item_category string, "
    "item_subcategory string, maximum_stock int, current_stock int, item_price double"
)
LOT_SNAPSHOT = _s(
    "shelf_id string, batch_code string, item_category string, item_subcategory string, standard_batch_size int, "
    "received_date date, expiry_date date, batch_quantity_total int, batch_quantity_store int, "
    "batch_quantity_warehouse int, location string"
)
DAILY_FEATURES = _s(
    "shelf_id string, feature_date date, item_category string, item_subcategory string, day_of_week int, "
    "is_weekend boolean, warehouse_inbound_day boolean, refill_day boolean, item_price double, discount double, "
    "is_discounted boolean, is_discounted_next_7d boolean, people_count int, sales_qty int, sales_last_1d int, "
    "sales_last_7d int, sales_last_14d int, stockout_events int, shelf_capacity int, current_stock_shelf int, "
    "shelf_fill_ratio double, shelf_threshold_qty int, expired_qty_shelf int, alerts_last_30d_shelf int, "
    "is_shelf_alert boolean, warehouse_capacity int, current_stock_warehouse int, warehouse_fill_ratio double, "
    "wh_reorder_point_qty int, pending_supplier_qty int, expired_qty_wh int, alerts_last_30d_wh int, "
    "is_warehouse_alert boolean, moved_wh_to_shelf int, standard_batch_size int, min_expiration_days double, "
    "avg_expiration_days double, qty_expiring_next_7d int, batches_to_order int, label_next_day_stockout boolean"
)
PREDICTIONS = _s(
    "model_name string, feature_date date, shelf_id string, predicted_batches int, suggested_qty int, "
    "model_version string, created_at timestamp"
)
MODELS = _s("model_name string, model_version string, trained_at timestamp, metrics_json string, artifact_path string")

# Tables made at set-up, by area and name.
TABLES = {
    "raw/shelf_events": SHELF_EVENTS,
    "raw/pos_transactions": POS_TRANSACTIONS,
    "raw/foot_traffic": FOOT_TRAFFIC,
    "raw/wh_events": WH_EVENTS,
    "cleansed/shelf_state": SHELF_STATE,
    "cleansed/wh_state": WH_STATE,
    "cleansed/shelf_batch_state": SHELF_BATCH_STATE,
    "cleansed/wh_batch_state": WH_BATCH_STATE,
    "curated/product_total_state": PRODUCT_TOTAL_STATE,
    "curated/features_store": DAILY_FEATURES,
    "curated/predictions": PREDICTIONS,
    "ops/alerts": ALERTS,
    "ops/wh_supplier_orders": SUPPLIER_ORDERS,
    "ops/wh_supplier_receipts": SUPPLIER_RECEIPTS,
    "ops/wh_supplier_plan": SUPPLIER_PLAN,
    "ops/shelf_restock_plan": RESTOCK_PLAN,
}

# Message keys of the changelog topics; event topics have none.
TOPIC_KEYS = {
    "shelf_state": ("shelf_id",),
    "wh_state": ("shelf_id",),
    "shelf_batch_state": ("shelf_id", "batch_code"),
    "wh_batch_state": ("shelf_id", "batch_code"),
    "daily_discounts": ("shelf_id", "discount_date"),
    "shelf_restock_plan": ("shelf_id",),
    "wh_supplier_plan": ("shelf_id",),
    "shelf_policies": ("shelf_id",),
    "wh_policies": ("shelf_id",),
    "batch_catalog": ("batch_code",),
    "shelf_profiles": ("shelf_id",),
}

# Allowed values.
WH_EVENT_TYPES = ("wh_in", "wh_out")
ALERT_STATUSES = ("open", "ack", "resolved", "dismissed")
PLAN_STATUSES = ("pending", "issued", "completed", "canceled")


def wire(schema: T.StructType) -> T.StructType:
    """The schema as sent in messages: times and dates are text."""
    text = (T.TimestampType, T.DateType)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, text) else f.dataType) for f in schema])
