"""Reference snapshots to configuration: profiles, lot catalogue, default policies, reorder points."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.stock import DEFAULT_MIN_QTY, DEFAULT_THRESHOLD_PCT, reorder_point
from ..operators.latest import latest_per_key, latest_slice
from ..operators.merge import insert_if_absent
from ..sources.files import read_csv

LATEST_SNAPSHOT = "snapshot_ts"


def load_reference(spark: SparkSession, folder: str, now) -> dict[str, DataFrame]:
    """The four CSV snapshots, stamped with the load time."""
    files = {
        "store_inventory": schemas.STORE_INVENTORY, "warehouse_inventory": schemas.WAREHOUSE_INVENTORY,
        "store_batches": schemas.LOT_SNAPSHOT, "warehouse_batches": schemas.LOT_SNAPSHOT,
    }
    return {n: read_csv(spark, f"{folder}/{n}.csv", s, ["shelf_id"]).withColumn(LATEST_SNAPSHOT, now) for n, s in files.items()}


def load_panel(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.DAILY_FEATURES, ["shelf_id", "feature_date"])


def shelf_profiles(store: DataFrame) -> DataFrame:
    """Unit weight per shelf from the latest store snapshot."""
    return latest_slice(store, LATEST_SNAPSHOT).groupBy("shelf_id").agg(F.max("item_weight").alias("item_weight"))


def batch_catalog(store_lots: DataFrame, wh_lots: DataFrame) -> DataFrame:
    """One row per lot code from the latest snapshot of store and warehouse lots."""
    cols = [LATEST_SNAPSHOT, "batch_code", "shelf_id", "expiry_date", "standard_batch_size"]
    both = store_lots.select(*cols).unionByName(wh_lots.select(*cols))
    latest = latest_slice(both, LATEST_SNAPSHOT)
    return latest_per_key(latest, ["batch_code"], [LATEST_SNAPSHOT]).drop(LATEST_SNAPSHOT)


def batch_sizes(*lots: DataFrame) -> DataFrame:
    """Largest positive standard batch size per shelf over all given lot tables."""
    cols = ["shelf_id", "standard_batch_size"]
    both = lots[0].select(*cols)
    for other in lots[1:]:
        both = both.union(other.select(*cols))
    return (
        both.where("shelf_id is not null and standard_batch_size > 0").groupBy("shelf_id")
        .agg(F.max("standard_batch_size").alias("standard_batch_size"))
    )


def default_shelf_policies(store: DataFrame, policies: DataFrame) -> DataFrame:
    """Policy rows to add: one global row and one per shelf of the latest snapshot, where absent."""
    defaults = [
        F.lit(DEFAULT_THRESHOLD_PCT).alias("threshold_pct"), F.lit(DEFAULT_MIN_QTY).alias("min_qty"), F.lit(True).alias("active"),
    ]
    keys = ["shelf_id", "item_category", "item_subcategory"]
    one_row = store.sparkSession.range(1)
    globally = one_row.select(*[F.lit(None).cast("string").alias(k) for k in keys], *defaults)
    globally = insert_if_absent(policies, globally, keys, null_safe=True)
    per_shelf = latest_slice(store, LATEST_SNAPSHOT).select(*keys, *defaults)
    return globally.unionByName(insert_if_absent(policies, per_shelf, ["shelf_id"]))


def default_wh_policies(warehouse: DataFrame, policies: DataFrame) -> DataFrame:
    """Reorder points to add: 5 % of the capacity, at least one."""
    rows = latest_slice(warehouse, LATEST_SNAPSHOT).select(
        "shelf_id", "item_category", "item_subcategory",
        reorder_point("maximum_stock", "current_stock").alias("reorder_point_qty"), F.lit(True).alias("active"),
    )
    return insert_if_absent(policies, rows, ["shelf_id"])


def products(store: DataFrame, warehouse: DataFrame, sizes: DataFrame, default_size: int = 24) -> DataFrame:
    """Store inventory with warehouse capacity, stock and batch size; missing ones are 0 and the default size."""
    wh = warehouse.select(
        "shelf_id", F.col("maximum_stock").alias("warehouse_capacity"), F.col("current_stock").alias("stock_warehouse")
    )
    full = store.join(wh, "shelf_id", "left").join(sizes, "shelf_id", "left")
    return full.fillna({"warehouse_capacity": 0, "stock_warehouse": 0, "standard_batch_size": default_size})


def latest_policies(policies: DataFrame, keys: Sequence[str] = ("shelf_id",), order_by: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Latest revision per key, then only active ones: a newer inactive revision hides an older active one.

    A null shelf is the global policy.
    """
    return latest_per_key(policies, list(keys), order_by).where("active")
