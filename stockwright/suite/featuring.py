"""Queries over the daily feature table, the panel and the model views."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.align import align_to_schema
from ..plans import features as X
from ..schemas import DAILY_FEATURES
from .fixtures import Inputs, now_ts, oracle, today
from .state import DAY, SHELF_PARTS, TS, WH_PARTS, state_of, wh_state_of

LAST_DAY = "2001-11-04"


def lots_in(i: Inputs):
    return i["wh_lots"]


def headers(i: Inputs):
    return i.sql("SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders")


def lines(i: Inputs):
    return i.sql("SELECT l_orderkey AS transaction_id, 'S' || CAST(l_partkey AS STRING) AS shelf_id, CAST(l_quantity AS INT) AS quantity FROM lineitem")


def feature_inputs(i: Inputs) -> dict:
    inventory = i["inventory"].withColumn("snapshot_ts", now_ts())
    store = inventory.select("shelf_id", "item_category", "item_subcategory", "maximum_stock", "item_price", "snapshot_ts")
    warehouse = inventory.where("item_category <> 'SMALL'").select("shelf_id", F.col("warehouse_capacity").alias("maximum_stock"), "snapshot_ts")
    return {
        "store": store, "warehouse": warehouse,
        "batches": inventory.where("item_category <> 'LARGE'").select("shelf_id", "standard_batch_size"),
        "shelf_state": state_of(i), "wh_state": wh_state_of(i), "wh_policies": i["wh_policies"], "supplier_plans": i["supplier_plans"],
        "lots": lots_in(i), "headers": headers(i), "lines": lines(i), "discounts": i["daily_discounts"], "history": i["raw_panel"],
    }


def features_of(i: Inputs):
    return X.daily_features(feature_inputs(i), today())


def shown(df):
    # Nine places: a ratio of whole numbers may end in a 5 at the seventh.
    return df.withColumns({c: F.round(c, 9) for c in ("shelf_fill_ratio", "warehouse_fill_ratio", "avg_expiration_days", "discount")})


def q_backfill(i: Inputs):
    """Labels of a day from the next one, on the panel."""
    table = i["raw_panel"].withColumn("label_next_day_stockout", F.lit(None).cast("boolean"))
    return X.backfill_label(table, today()).select("shelf_id", "feature_date", "label_next_day_stockout")


def q_store(i: Inputs):
    """The day's rows merged into a feature table that already holds some of them."""
    table = align_to_schema(i["feature_rows"], DAILY_FEATURES)
    fresh = table.where(F.col("feature_date") == today()).withColumn("sales_qty", F.col("sales_qty") + 1)
    return X.upsert_features(table, fresh, now_ts()).select("shelf_id", "feature_date", "sales_qty", "snapshot_ts")


def q_lags(i: Inputs):
    return X.sales_lags(i["raw_panel"]).select("shelf_id", "feature_date", "sales_last_1d")


def q_rolling(i: Inputs):
    return X.sales_lags(i["raw_panel"]).select("shelf_id", "feature_date", "sales_last_7d", "sales_last_14d")


def q_panel(i: Inputs):
    return X.panel_features(i["raw_panel"]).select(
        "shelf_id", "feature_date", "sales_last_1d", "sales_last_7d", "sales_last_14d", "alerts_last_30d_shelf", "alerts_last_30d_wh",
        "is_discounted_next_7d", "label_next_day_stockout")


def q_demand(i: Inputs):
    return X.demand_next_7d(align_to_schema(i["feature_rows"], DAILY_FEATURES), F.lit(LAST_DAY).cast("date")).select(
        "shelf_id", "feature_date", "item_category", "sales_last_7d", "y_sales_next_7d")


def q_ewma(i: Inputs):
    return X.ewma(i["raw_panel"], "shelf_id", "feature_date", "sales_qty", F.lit(2.0)).select("shelf_id", F.round("demand_ewma", 6).alias("demand_ewma"))


VIEW = ["shelf_id", "feature_date", "is_weekend", "refill_day", "item_price", "discount", "is_discounted", "people_count", "sales_last_7d",
        "pending_supplier_qty", "is_warehouse_alert", "standard_batch_size", "min_expiration_days", "avg_expiration_days", "batches_to_order",
        "warehouse_capacity"]

QUERIES = {
    "expiry_features": lambda i: X.expiry_features(lots_in(i), today()).withColumn("avg_expiration_days", F.round("avg_expiration_days", 9)),
    "sales_rollups": lambda i: X.sales_rollups(i["raw_panel"], today()),
    "daily_sales": lambda i: X.daily_sales(headers(i), lines(i), today()),
    "pending_supplier": lambda i: X.open_supply(i["supplier_plans"]),
    "daily_features": lambda i: shown(features_of(i)),
    "label_backfill": q_backfill,
    "feature_upsert": q_store,
    "panel_lags": q_lags,
    "panel_rolling": q_rolling,
    "alert_history": lambda i: X.alert_history(i["raw_panel"], "is_shelf_alert", "n", by_rows=False).select("shelf_id", "feature_date", "n"),
    "discount_next_7d": lambda i: X.discount_ahead(i["raw_panel"]).select("shelf_id", "feature_date", "is_discounted_next_7d"),
    "next_day_label": lambda i: X.next_day_label(i["raw_panel"]).select("shelf_id", "feature_date", "label_next_day_stockout"),
    "panel_features": q_panel,
    "demand_next_7d": q_demand,
    "demand_ewma": q_ewma,
    "ml_features": lambda i: X.ml_features(align_to_schema(i["feature_rows"], DAILY_FEATURES)).select(*VIEW),
    "ml_train": lambda i: X.ml_train(align_to_schema(i["feature_rows"], DAILY_FEATURES)).select(*VIEW),
}

W = "OVER (PARTITION BY shelf_id ORDER BY feature_date"
_full = lambda n: f"CAST(CASE WHEN COUNT(*) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) = {n} THEN SUM(sales_qty) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) ELSE 0 END AS INT)"
_exp = f"""SELECT shelf_id, CAST(MIN(expiry_date - {DAY}) AS INT) AS min_expiration_days, ROUND(AVG(expiry_date - {DAY}), 9) AS avg_expiration_days,
  CAST(SUM(CASE WHEN expiry_date BETWEEN {DAY} AND {DAY} + 6 THEN qty ELSE 0 END) AS INT) AS qty_expiring_next_7d FROM wh_lots WHERE qty > 0 GROUP BY shelf_id"""
_roll = f"""SELECT shelf_id, CAST(SUM(CASE WHEN feature_date = {DAY} - 1 THEN sales_qty ELSE 0 END) AS INT) AS sales_last_1d,
  CAST(SUM(CASE WHEN feature_date >= {DAY} - 7 THEN sales_qty ELSE 0 END) AS INT) AS sales_last_7d,
  CAST(SUM(CASE WHEN feature_date >= {DAY} - 14 THEN sales_qty ELSE 0 END) AS INT) AS sales_last_14d,
  CAST(SUM(is_shelf_alert) AS INT) AS alerts_last_30d_shelf, CAST(SUM(is_warehouse_alert) AS INT) AS alerts_last_30d_wh
  FROM raw_panel WHERE feature_date BETWEEN {DAY} - 30 AND {DAY} - 1 GROUP BY shelf_id"""
_sales = f"""SELECT 'S' || CAST(l_partkey AS STRING) AS shelf_id, CAST(SUM(l_quantity) AS INT) AS sales_qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE CAST(o_orderdate AS DATE) = {DAY} GROUP BY l_partkey"""
_open = """SELECT shelf_id, CAST(SUM(suggested_qty) AS INT) AS pending_supplier_qty FROM supplier_plans WHERE lower(trim(status)) IN ('pending', 'issued') GROUP BY shelf_id"""
_features = f"""SELECT i.shelf_id, {DAY} AS feature_date, i.item_category, i.item_subcategory, 0 AS day_of_week, FALSE AS is_weekend,
  FALSE AS warehouse_inbound_day, FALSE AS refill_day, i.item_price, ROUND(COALESCE(d.discount, 0.0), 9) AS discount,
  COALESCE(d.discount, 0) > 0 AS is_discounted,
  i.shelf_id IN (SELECT shelf_id FROM daily_discounts WHERE discount > 0 AND discount_date BETWEEN {DAY} AND {DAY} + 6) AS is_discounted_next_7d,
  CAST(NULL AS INT) AS people_count, COALESCE(sa.sales_qty, 0) AS sales_qty, r.sales_last_1d, r.sales_last_7d, r.sales_last_14d,
  0 AS stockout_events, i.maximum_stock AS shelf_capacity, COALESCE(s.current_stock, 0) AS current_stock_shelf,
  ROUND(CASE WHEN i.maximum_stock > 0 THEN COALESCE(s.current_stock, 0) / i.maximum_stock ELSE 0 END, 9) AS shelf_fill_ratio,
  CAST(NULL AS INT) AS shelf_threshold_qty, 0 AS expired_qty_shelf, COALESCE(r.alerts_last_30d_shelf, 0) AS alerts_last_30d_shelf,
  FALSE AS is_shelf_alert, i.wcap AS warehouse_capacity, COALESCE(w.wh_current_stock, 0) AS current_stock_warehouse,
  ROUND(CASE WHEN i.wcap > 0 THEN COALESCE(w.wh_current_stock, 0) / i.wcap ELSE 0 END, 9) AS warehouse_fill_ratio,
  COALESCE(p.reorder_point_qty, 10) AS wh_reorder_point_qty, COALESCE(o.pending_supplier_qty, 0) AS pending_supplier_qty, 0 AS expired_qty_wh,
  COALESCE(r.alerts_last_30d_wh, 0) AS alerts_last_30d_wh,
  i.wcap > 0 AND COALESCE(w.wh_current_stock, 0) < COALESCE(p.reorder_point_qty, 10) AS is_warehouse_alert, 0 AS moved_wh_to_shelf,
  i.bs AS standard_batch_size, CAST(e.min_expiration_days AS DOUBLE) AS min_expiration_days, e.avg_expiration_days, e.qty_expiring_next_7d,
  0 AS batches_to_order, CAST(NULL AS BOOLEAN) AS label_next_day_stockout
  FROM (SELECT *, CASE WHEN item_category <> 'SMALL' THEN warehouse_capacity ELSE 0 END AS wcap,
        CASE WHEN item_category <> 'LARGE' THEN standard_batch_size ELSE 24 END AS bs FROM inventory) i
  LEFT JOIN state s ON i.shelf_id = s.shelf_id LEFT JOIN wh_state w ON i.shelf_id = w.shelf_id
  LEFT JOIN (SELECT * FROM wh_policies WHERE active) p ON i.shelf_id = p.shelf_id LEFT JOIN exp e ON i.shelf_id = e.shelf_id
  LEFT JOIN roll r ON i.shelf_id = r.shelf_id LEFT JOIN sales sa ON i.shelf_id = sa.shelf_id LEFT JOIN opn o ON i.shelf_id = o.shelf_id
  LEFT JOIN (SELECT shelf_id, MAX(discount) AS discount FROM daily_discounts WHERE discount_date = {DAY} GROUP BY shelf_id) d ON i.shelf_id = d.shelf_id"""
_view = """SELECT shelf_id, feature_date, CAST(is_weekend AS INT) AS is_weekend, CAST(refill_day AS INT) AS refill_day, item_price, COALESCE(discount, 0) AS discount,
  CAST(is_discounted AS INT) AS is_discounted, COALESCE(people_count, 0) AS people_count, COALESCE(sales_last_7d, 0) AS sales_last_7d,
  COALESCE(pending_supplier_qty, 0) AS pending_supplier_qty, CAST(is_warehouse_alert AS INT) AS is_warehouse_alert,
  COALESCE(standard_batch_size, 1) AS standard_batch_size, COALESCE(min_expiration_days, 9999) AS min_expiration_days,
  COALESCE(avg_expiration_days, 9999) AS avg_expiration_days, COALESCE(batches_to_order, 0) AS batches_to_order,
  COALESCE(warehouse_capacity, 0) AS warehouse_capacity FROM feature_rows"""
_panel = {
    "sales_last_1d": f"LAG(sales_qty, 1, 0) {W})",
    "sales_last_7d": _full(7), "sales_last_14d": _full(14),
    "alerts_last_30d_shelf": f"CAST(COALESCE(SUM(is_shelf_alert) {W} ROWS BETWEEN 29 PRECEDING AND 1 PRECEDING), 0) AS INT)",
    "alerts_last_30d_wh": f"CAST(COALESCE(SUM(is_warehouse_alert) {W} ROWS BETWEEN 29 PRECEDING AND 1 PRECEDING), 0) AS INT)",
    "is_discounted_next_7d": f"CAST(MAX(CASE WHEN discount > 0 THEN 1 ELSE 0 END) {W} ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS INT)",
    "label_next_day_stockout": f"COALESCE(LEAD(stockout_events) {W}) > 0, FALSE)",
}
_cols = lambda *names: ", ".join(f"{_panel[n]} AS {n}" for n in names)
_panel_sql = lambda *names: oracle(f"SELECT shelf_id, feature_date, {_cols(*names)} FROM raw_panel", "raw_panel")

ORACLES = {
    "expiry_features": oracle("SELECT * FROM exp", "wh_lots", exp=_exp),
    "sales_rollups": oracle("SELECT * FROM roll", "raw_panel", roll=_roll),
    "daily_sales": oracle("SELECT * FROM sales", sales=_sales),
    "pending_supplier": oracle("SELECT * FROM opn", "supplier_plans", opn=_open),
    "daily_features": oracle("SELECT * FROM f", "inventory", "shelf_events", "wh_events", "wh_lots", "wh_policies", "supplier_plans", "daily_discounts",
                             "raw_panel", **SHELF_PARTS, **WH_PARTS, exp=_exp, roll=_roll, sales=_sales, opn=_open, f=_features),
    "label_backfill": oracle(
        f"""SELECT a.shelf_id, a.feature_date, b.stockout_events > 0 AS label_next_day_stockout FROM raw_panel a LEFT JOIN raw_panel b
            ON a.shelf_id = b.shelf_id AND b.feature_date = a.feature_date + 1 AND b.feature_date = {DAY}""", "raw_panel"),
    "feature_upsert": oracle(
        f"""SELECT shelf_id, feature_date, CAST(CASE WHEN feature_date = {DAY} THEN sales_qty + 1 ELSE sales_qty END AS INT) AS sales_qty,
            CASE WHEN feature_date = {DAY} THEN {TS} END AS snapshot_ts FROM feature_rows""", "feature_rows"),
    "panel_lags": _panel_sql("sales_last_1d"),
    "panel_rolling": _panel_sql("sales_last_7d", "sales_last_14d"),
    "alert_history": oracle(
        """SELECT shelf_id, feature_date, CAST(COALESCE(SUM(is_shelf_alert) OVER (PARTITION BY shelf_id ORDER BY feature_date
           RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING), 0) AS INT) AS n FROM raw_panel""", "raw_panel"),
    "discount_next_7d": _panel_sql("is_discounted_next_7d"),
    "next_day_label": _panel_sql("label_next_day_stockout"),
    "panel_features": _panel_sql(*_panel),
    "demand_next_7d": oracle(
        f"""SELECT a.shelf_id, a.feature_date, a.item_category, a.sales_last_7d, CAST(COALESCE(SUM(b.sales_qty), 0) AS INT) AS y_sales_next_7d
            FROM feature_rows a LEFT JOIN feature_rows b ON a.shelf_id = b.shelf_id AND b.feature_date > a.feature_date AND b.feature_date <= a.feature_date + 7
            WHERE a.feature_date <= DATE '{LAST_DAY}' - 7 GROUP BY ALL""", "feature_rows"),
    "demand_ewma": oracle(
        """SELECT shelf_id, ROUND(SUM(0.1 * POW(0.9::DOUBLE, n - k) * sales_qty) + POW(0.9::DOUBLE, MAX(n)) * 2.0, 6) AS demand_ewma FROM
           (SELECT *, ROW_NUMBER() OVER (PARTITION BY shelf_id ORDER BY feature_date) AS k, COUNT(*) OVER (PARTITION BY shelf_id) AS n FROM raw_panel)
           GROUP BY shelf_id""", "raw_panel"),
    "ml_features": oracle(_view, "feature_rows"),
    "ml_train": oracle(f"SELECT * FROM ({_view}) WHERE warehouse_capacity > 0", "feature_rows"),
}
