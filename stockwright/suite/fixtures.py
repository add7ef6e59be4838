"""The reference inputs of the engine expressed over the test tables.

Each fixture is one SQL text that runs unchanged in Spark and in DuckDB, so the checked query and
its SQL check start from the same rows. Every fixture covers its whole table.
"""
from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import stream_files

NOW = "1998-06-01 12:00:00"
TODAY = "1998-06-01"
VISIT_NOW = "2024-01-15 12:00:00"


def now_ts():
    return F.lit(NOW).cast("timestamp")


def today():
    return F.lit(TODAY).cast("date")


def visit_now():
    return F.lit(VISIT_NOW).cast("timestamp")


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

FIXTURES = {
    "inventory": """
SELECT 'S' || CAST(p_partkey AS STRING) AS shelf_id, p_type AS item_category, p_brand AS item_subcategory,
       CAST(p_size AS DOUBLE) AS item_weight, p_retailprice AS item_price,
       p_size * 20 AS maximum_stock, p_size * 15 AS current_stock, p_size * 100 AS warehouse_capacity,
       CAST(5 + p_partkey % 20 AS INT) AS standard_batch_size
FROM part""",
    "shelf_events": """
SELECT 'S' || CAST(l_partkey AS STRING) AS shelf_id, 'S' || CAST(l_partkey AS STRING) AS item_id,
       'C' || CAST(l_orderkey % 500 AS STRING) AS customer_id,
       CASE WHEN l_returnflag = 'R' THEN 'putback'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'weight_change' ELSE 'pickup' END AS event_type,
       CAST(l_quantity AS INT) AS quantity, CAST(l_shipdate AS TIMESTAMP) AS ts,
       l_orderkey AS seq1, l_linenumber AS seq2, l_suppkey AS seq3, l_extendedprice AS seq4
FROM lineitem""",
    "wh_events": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS event_id,
       CASE WHEN l_linestatus = 'F' THEN 'wh_in' ELSE 'wh_out' END AS event_type,
       'S' || CAST(l_partkey AS STRING) AS shelf_id,
       'B' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS batch_code,
       CAST(l_quantity AS INT) AS qty, CAST(l_shipdate AS TIMESTAMP) AS ts,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS received_date,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(30 + l_suppkey % 30 AS INT) END AS expiry_date
FROM lineitem""",
    "wh_lots": """
SELECT 'S' || CAST(l_partkey AS STRING) AS shelf_id,
       'B' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS batch_code,
       MIN(CAST(l_shipdate AS DATE)) AS received_date,
       MAX(CAST(l_shipdate AS DATE)) + CAST(l_suppkey % 30 AS INT) AS expiry_date,
       CAST(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS INT) AS qty,
       CAST(MAX(l_shipdate) AS TIMESTAMP) AS last_update_ts
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "restock_plans": """
SELECT 'P' || CAST(p_partkey AS STRING) AS plan_id, 'S' || CAST(p_partkey % 1000 AS STRING) AS shelf_id,
       p_size * 3 AS suggested_qty,
       CASE WHEN p_partkey % 5 = 0 THEN 'issued' ELSE 'pending' END AS status,
       TIMESTAMP '1998-06-01 11:58:00' + INTERVAL '1' SECOND * CAST(p_partkey % 120 AS INT) AS created_at
FROM part""",
    # Exits with one row per id (the test tables hold some order lines twice).
    "wh_exits": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS event_id, 'wh_out' AS event_type,
       'S' || CAST(l_partkey AS STRING) AS shelf_id, 'B' || CAST(MAX(l_suppkey) AS STRING) AS batch_code, CAST(MAX(l_quantity) AS INT) AS qty,
       MAX(CAST(l_shipdate AS TIMESTAMP)) AS ts
FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey""",
    # The same shelves seen three times, an hour apart, with other stocks.
    "shelf_waves": "\nUNION ALL".join(f"""
SELECT 'S' || CAST(p_partkey AS STRING) AS shelf_id, CAST(p_size * 2 * ((p_partkey + {3 * wave}) % 10) AS INT) AS current_stock, {wave} AS wave,
       TIMESTAMP '1998-06-01 {9 + wave:02}:00:00' AS last_update_ts
FROM part""" for wave in range(3)),
    # Alerts raised, raised again after 30 minutes, and after 50 or 61.
    "alert_waves": "\nUNION ALL".join(f"""
SELECT CASE event_type WHEN 'error' THEN 'refill_request' WHEN 'view' THEN 'near_expiry' ELSE 'supplier_request' END AS event_type,
       'S' || CAST(user_id AS STRING) AS shelf_id, CASE user_id % 2 WHEN 0 THEN 'store' ELSE 'warehouse' END AS location, {wave} AS wave,
       TIMESTAMP '1998-06-01 12:00:00' + INTERVAL '1' MINUTE * CAST({minutes} AS INT) AS created_at
FROM events""" for wave, minutes in enumerate(("0", "30", "CASE WHEN user_id % 3 = 0 THEN 50 ELSE 61 END"))),
    # Shelves of two item types have their own policy, with an older and a newer revision; one row is global.
    "shelf_policies": """
SELECT 'S' || CAST(p_partkey AS STRING) AS shelf_id, CAST(20 + p_size % 20 AS DOUBLE) AS threshold_pct,
       p_size % 7 AS min_qty, p_partkey % 9 <> 0 AS active, DATE '1998-01-01' + CAST(p_partkey % 30 AS INT) AS updated_at
FROM part WHERE p_type IN ('PROMO', 'ECONOMY')
UNION ALL
SELECT 'S' || CAST(p_partkey AS STRING), CAST(50.0 AS DOUBLE), 3, TRUE, DATE '1997-01-01' FROM part WHERE p_type IN ('PROMO', 'ECONOMY')
UNION ALL
SELECT CAST(NULL AS STRING), CAST(30.0 AS DOUBLE), 1, TRUE, DATE '1998-01-01'""",
    "wh_policies": """
SELECT 'S' || CAST(p_partkey AS STRING) AS shelf_id, p_size * 4 AS reorder_point_qty, p_size % 5 <> 0 AS active,
       DATE '1998-01-01' + CAST(p_partkey % 30 AS INT) AS updated_at
FROM part WHERE p_type <> 'SMALL'""",
    "receipt_lines": """
SELECT o_orderkey AS transaction_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS ts,
       'S' || CAST(l_partkey AS STRING) AS item_id,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'B' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END AS batch_code,
       CAST(l_quantity AS INT) AS quantity, l_discount AS discount
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "visits": """
SELECT 'U' || CAST(user_id AS STRING) AS customer_id, event_id, CAST(ts AS TIMESTAMP) AS entry_time,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) + INTERVAL '1' MINUTE * CAST(10 + event_id % 66 AS INT) END AS exit_time,
       CAST(10 + event_id % 66 AS INT) AS trip_duration_minutes
FROM events""",
    # Visits of the shoppers in shelf_events; the number in the id keeps visits of one day apart.
    "shop_visits": """
SELECT 'V' || CAST(o_orderkey AS STRING) AS visit_id, 'C' || CAST(o_orderkey % 500 AS STRING) AS customer_id,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * CAST(o_orderkey % 86400 AS INT) AS entry_time,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * CAST(o_orderkey % 86400 AS INT) + INTERVAL '1' DAY * CAST(1 + o_custkey % 20 AS INT) END AS exit_time
FROM orders""",
    # Shelf-days with movement.
    "raw_panel": """
SELECT 'S' || CAST(l_partkey AS STRING) AS shelf_id, CAST(l_shipdate AS DATE) AS feature_date,
       CAST(SUM(l_quantity) AS INT) AS sales_qty,
       CASE WHEN SUM(l_quantity) >= 40 THEN 1 ELSE 0 END AS stockout_events,
       MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS is_shelf_alert,
       MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS is_warehouse_alert,
       MAX(l_discount) AS discount
FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    # Inclusive (span 6) and exclusive (span 7) weeks, some discounts in percent, overlaps on purpose.
    "weekly_discounts": """
SELECT 'S' || CAST(p_partkey % 200 AS STRING) AS shelf_id,
       DATE '1998-05-04' + CAST(7 * (p_partkey % 6) AS INT) AS week_start,
       DATE '1998-05-04' + CAST(7 * (p_partkey % 6) + 6 + p_partkey % 2 AS INT) AS week_end,
       CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS DOUBLE) + 1 ELSE CAST(p_size AS DOUBLE) / 100 END AS discount_pct
FROM part""",
    "daily_discounts": """
SELECT 'S' || CAST(p_partkey AS STRING) AS shelf_id, DATE '1998-05-25' + CAST(p_partkey % 15 AS INT) AS discount_date,
       CAST(p_size % 4 AS DOUBLE) / 10 AS discount
FROM part""",
    "supplier_plans": """
SELECT 'SP' || CAST(p_partkey AS STRING) AS supplier_plan_id, 'S' || CAST(p_partkey % 1500 AS STRING) AS shelf_id,
       p_size * 2 AS suggested_qty,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(5 + p_partkey % 20 AS INT) END AS standard_batch_size,
       CASE p_partkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN ' Pending' WHEN 2 THEN 'issued' ELSE 'completed' END AS status,
       TIMESTAMP '1998-05-20 12:00:00' AS created_at, TIMESTAMP '1998-05-20 12:00:00' AS updated_at
FROM part""",
    "supplier_orders": """
SELECT 'O' || CAST(p_partkey AS STRING) AS order_id, DATE '1998-06-01' + CAST(p_partkey % 3 AS INT) AS delivery_date,
       'S' || CAST(p_partkey AS STRING) AS shelf_id, p_size * 5 AS total_qty,
       CASE WHEN p_partkey % 10 = 9 THEN 'delivered' WHEN p_partkey % 10 = 8 THEN ' Cancelled' ELSE 'issued' END AS status,
       TIMESTAMP '1998-05-28 12:00:00' AS cutoff_ts,
       CASE WHEN p_partkey % 4 = 0 THEN NULL
            ELSE TIMESTAMP '1998-06-01 08:00:00' + INTERVAL '1' DAY * CAST(p_partkey % 3 AS INT) END AS delivery_ts,
       TIMESTAMP '1998-05-28 12:00:00' AS created_at, TIMESTAMP '1998-05-28 12:00:00' AS updated_at
FROM part""",
    "supplier_receipts": """
SELECT 'R' || CAST(p_partkey AS STRING) AS receipt_id, DATE '1998-06-01' AS delivery_date,
       'S' || CAST(p_partkey AS STRING) AS shelf_id, p_size * 5 AS received_qty, TIMESTAMP '1998-06-01 08:00:00' AS created_at
FROM part WHERE p_type = 'LARGE'""",
    "alert_history": """
SELECT CAST(event_id AS STRING) AS alert_id,
       CASE event_type WHEN 'error' THEN 'refill_request' WHEN 'view' THEN 'near_expiry' ELSE 'supplier_request' END AS event_type,
       'S' || CAST(user_id AS STRING) AS shelf_id,
       CASE event_id % 4 WHEN 0 THEN 'store' WHEN 1 THEN ' Warehouse' WHEN 2 THEN 'shop floor' ELSE 'wh-1' END AS location,
       CASE event_id % 6 WHEN 0 THEN 'open' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'closed' WHEN 3 THEN 'ignored' WHEN 4 THEN '' ELSE 'ack' END AS status,
       CAST(ts AS TIMESTAMP) AS created_at
FROM events""",
    # Alerts raised around NOW, so that the cooldown has something to match.
    "recent_alerts": """
SELECT 'S' || CAST(p_partkey AS STRING) AS shelf_id,
       CASE p_size % 3 WHEN 0 THEN 'refill_request' WHEN 1 THEN 'near_expiry' ELSE 'supplier_request' END AS event_type,
       CASE WHEN p_size % 3 = 2 THEN 'warehouse' ELSE 'store' END AS location,
       TIMESTAMP '1998-06-01 10:30:00' + INTERVAL '1' MINUTE * CAST(p_partkey % 90 AS INT) AS created_at
FROM part""",
    "status_changes": """
SELECT CASE WHEN event_id % 5 = 0 THEN CAST(event_id AS STRING) ELSE NULL END AS alert_id,
       'S' || CAST(user_id AS STRING) AS shelf_id,
       CASE event_id % 4 WHEN 0 THEN 'store' WHEN 1 THEN ' Warehouse' WHEN 2 THEN 'shop floor' ELSE 'wh-1' END AS location,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_type = 'error' THEN 'refill_request' WHEN event_type = 'view' THEN 'near_expiry' ELSE 'supplier_request' END AS alert_event_type,
       CASE event_id % 7 WHEN 0 THEN 'Done' WHEN 1 THEN 'ack' WHEN 2 THEN ' NEW ' WHEN 3 THEN 'odd' ELSE 'acknowledged' END AS status,
       event_id AS seq
FROM events""",
    # Feature rows over shelves and days with movement, for the model queries.
    "feature_rows": """
SELECT 'S' || CAST(l_partkey AS STRING) AS shelf_id, CAST(l_shipdate AS DATE) AS feature_date, MIN(p_type) AS item_category,
       MIN(p_brand) AS item_subcategory, CAST(MIN(l_linenumber) AS INT) AS day_of_week, MIN(l_linenumber) > 5 AS is_weekend,
       MAX(l_returnflag) = 'R' AS refill_day, MAX(p_retailprice) AS item_price, MAX(l_discount) AS discount,
       MAX(l_discount) > 0.05 AS is_discounted, MAX(l_discount) > 0.02 AS is_discounted_next_7d, CAST(NULL AS INT) AS people_count,
       CAST(SUM(l_quantity) AS INT) AS sales_qty, CAST(MAX(l_quantity) AS INT) AS sales_last_1d,
       CASE WHEN MAX(l_linenumber) > 6 THEN NULL ELSE CAST(SUM(l_quantity) * 3 AS INT) END AS sales_last_7d,
       CAST(SUM(l_quantity) * 5 AS INT) AS sales_last_14d, CASE WHEN SUM(l_quantity) >= 40 THEN 1 ELSE 0 END AS stockout_events,
       MAX(p_size) * 20 AS shelf_capacity, CAST(MAX(p_size) * 15 AS INT) AS current_stock_shelf,
       CAST(0.75 AS DOUBLE) AS shelf_fill_ratio, CAST(NULL AS INT) AS shelf_threshold_qty, 0 AS expired_qty_shelf,
       CAST(MIN(l_suppkey) % 4 AS INT) AS alerts_last_30d_shelf, MIN(l_suppkey) % 2 = 0 AS is_shelf_alert,
       CASE WHEN MAX(p_type) = 'SMALL' THEN 0 ELSE MAX(p_size) * 100 END AS warehouse_capacity,
       CAST(MAX(p_size) * MIN(l_linenumber) AS INT) AS current_stock_warehouse, CAST(0.25 AS DOUBLE) AS warehouse_fill_ratio,
       MAX(p_size) * 4 AS wh_reorder_point_qty, CAST(NULL AS INT) AS pending_supplier_qty, 0 AS expired_qty_wh,
       CAST(MIN(l_suppkey) % 3 AS INT) AS alerts_last_30d_wh, MAX(p_size) * MIN(l_linenumber) < MAX(p_size) * 4 AS is_warehouse_alert,
       0 AS moved_wh_to_shelf, CAST(5 + MIN(l_partkey) % 20 AS INT) AS standard_batch_size,
       CASE WHEN MIN(l_suppkey) % 9 = 0 THEN NULL ELSE CAST(MIN(l_suppkey) % 60 AS DOUBLE) END AS min_expiration_days,
       CASE WHEN MIN(l_suppkey) % 9 = 0 THEN NULL ELSE CAST(MAX(l_suppkey) % 90 AS DOUBLE) END AS avg_expiration_days,
       CAST(MIN(l_suppkey) % 12 AS INT) AS qty_expiring_next_7d,
       CASE WHEN MAX(p_size) * MIN(l_linenumber) < MAX(p_size) * 4 THEN CAST(1 + MAX(p_size) % 6 AS INT) ELSE 0 END AS batches_to_order,
       CAST(NULL AS BOOLEAN) AS label_next_day_stockout
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
}


def tables_in(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


class Inputs:
    """Fixtures as DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """SQL over test tables; further frames are named in braces."""
        for t in tables_in(text):
            text = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
            if t not in frames:
                frames[t] = self.table(t)
        return self.spark.sql(text, **frames)

    def __getitem__(self, name: str) -> DataFrame:
        return self.sql(FIXTURES[name])

    def stream(self, name: str, table: str, max_files: int | None = None) -> DataFrame:
        """A fixture over a test table read as a stream."""
        source = stream_files(self.spark, self.folder, self.table(table).schema, f"{table}.parquet", max_files)
        return self.sql(FIXTURES[name], **{table: source})

    @cached_property
    def profiles(self) -> DataFrame:
        return self["inventory"].select("shelf_id", "item_weight")

    @cached_property
    def opening_shelf(self) -> DataFrame:
        return self["inventory"].select(
            "shelf_id", "current_stock", "item_weight", F.lit("1998-01-01 00:00:00").cast("timestamp").alias("last_update_ts")
        )

    @cached_property
    def opening_wh(self) -> DataFrame:
        return self["inventory"].select(
            "shelf_id", (F.col("warehouse_capacity") / 2).cast("int").alias("wh_current_stock"),
            F.lit("1998-01-01 00:00:00").cast("timestamp").alias("last_update_ts"),
        )

    @cached_property
    def wh_lots(self) -> DataFrame:
        return self["wh_lots"].withColumnRenamed("qty", "batch_quantity_warehouse").withColumn("batch_quantity_store", F.lit(0))

    @cached_property
    def store_lots(self) -> DataFrame:
        return self["wh_lots"].withColumnRenamed("qty", "batch_quantity_store")


OPENING_SHELF = "SELECT shelf_id, current_stock, item_weight, TIMESTAMP '1998-01-01 00:00:00' AS last_update_ts FROM inventory"
OPENING_WH = "SELECT shelf_id, CAST(warehouse_capacity / 2 AS INT) AS wh_current_stock, TIMESTAMP '1998-01-01 00:00:00' AS last_update_ts FROM inventory"


def oracle(body: str, *fixtures: str, **ctes: str) -> str:
    """A check in SQL: the named fixtures and further parts as common table expressions, then the body."""
    parts = [f"{n} AS ({FIXTURES[n].strip()})" for n in fixtures] + [f"{n} AS ({s.strip()})" for n, s in ctes.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()
