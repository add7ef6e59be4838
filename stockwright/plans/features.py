"""Daily feature table, historical panel, model views.

Windows here run over one row per shelf and day, so a shelf never has more rows than the calendar
has days, however many events it had; events are summed per shelf and day before.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import stock as S
from ..functions.casts import flag
from ..functions.text import is_open_plan
from ..functions.times import INBOUND_DAYS, days_until
from ..operators.align import align_to_schema, strip_text
from ..operators.latest import latest_per_key
from ..operators.merge import upsert
from ..schemas import DAILY_FEATURES
from .config import latest_policies
from .discounts import discounted_next

UNKNOWN_EXPIRY = 9999


def expiry_features(lots: DataFrame, day: Column) -> DataFrame:
    """Days to expiry (least, and mean over lots) and quantity expiring within seven days from the day on."""
    left = days_until("expiry_date", day)
    return lots.where("qty > 0").groupBy("shelf_id").agg(
        F.min(left).alias("min_expiration_days"), F.avg(left).alias("avg_expiration_days"),
        F.sum(F.when(left.between(0, 6), F.col("qty")).otherwise(0)).cast("int").alias("qty_expiring_next_7d"),
    )


def sales_rollups(history: DataFrame, day: Column, alert_days: int = 30) -> DataFrame:
    """Sales of the last 1, 7 and 14 days and days in alert, per shelf, in one pass over the history."""
    ago = F.datediff(F.lit(day), F.col("feature_date"))
    sold = lambda n: F.sum(F.when(ago <= n, F.col("sales_qty")).otherwise(0)).cast("int").alias(f"sales_last_{n}d")
    alert = lambda c, out: F.sum(flag(c)).cast("int").alias(out)
    return history.where(F.col("feature_date").between(F.date_sub(day, alert_days), F.date_sub(day, 1))).groupBy("shelf_id").agg(
        sold(1), sold(7), sold(14), alert("is_shelf_alert", "alerts_last_30d_shelf"), alert("is_warehouse_alert", "alerts_last_30d_wh")
    )


def daily_sales(headers: DataFrame, lines: DataFrame, day: Column) -> DataFrame:
    """Units sold per shelf on a day: receipt headers of the day with their lines."""
    of_day = headers.where(F.to_date("ts") == day).select("transaction_id")
    return of_day.join(lines, "transaction_id").groupBy("shelf_id").agg(F.sum("quantity").cast("int").alias("sales_qty"))


def open_supply(plans: DataFrame) -> DataFrame:
    return plans.where(is_open_plan("status")).groupBy("shelf_id").agg(F.sum("suggested_qty").cast("int").alias("pending_supplier_qty"))


def daily_features(inputs: dict[str, DataFrame], day: Column, inbound_days=INBOUND_DAYS, flag_stockout: bool = False) -> DataFrame:
    """The 40-column feature row of every shelf for a day.

    inputs: store, warehouse, batches, shelf_state, wh_state, wh_policies, supplier_plans, lots,
    headers, lines, discounts, history. Each side shrinks to one row per shelf before the joins,
    which all use the shelf, so Spark shuffles each side once. flag_stockout counts an empty shelf
    as a stockout; the default leaves the count at 0.
    """
    i = {n: strip_text(df, ["shelf_id"]) for n, df in inputs.items()}
    base = latest_per_key(i["store"], ["shelf_id"], ["snapshot_ts"]).select(
        "shelf_id", "item_category", "item_subcategory", F.round("maximum_stock").cast("int").alias("shelf_capacity"), "item_price"
    )
    sides = [
        latest_per_key(i["warehouse"], ["shelf_id"], ["snapshot_ts"]).select(
            "shelf_id", F.round("maximum_stock").cast("int").alias("warehouse_capacity")),
        i["batches"].groupBy("shelf_id").agg(F.max("standard_batch_size").cast("int").alias("standard_batch_size")),
        i["shelf_state"].select("shelf_id", F.col("current_stock").alias("current_stock_shelf")),
        i["wh_state"].select("shelf_id", F.col("wh_current_stock").alias("current_stock_warehouse")),
        latest_policies(i["wh_policies"]).where("shelf_id is not null").select(
            "shelf_id", F.col("reorder_point_qty").alias("wh_reorder_point_qty")),
        open_supply(i["supplier_plans"]),
        expiry_features(i["lots"], day),
        daily_sales(i["headers"], i["lines"], day),
        i["discounts"].where(F.col("discount_date") == day).groupBy("shelf_id").agg(F.max("discount").alias("discount")),
        discounted_next(i["discounts"], day),
        sales_rollups(i["history"], day),
    ]
    wide = base
    for side in sides:
        wide = wide.join(side, "shelf_id", "left")
    wide = wide.fillna({
        "warehouse_capacity": 0, "current_stock_shelf": 0, "current_stock_warehouse": 0, "standard_batch_size": 24,
        "sales_qty": 0, "discount": 0.0, "is_discounted_next_7d": False, "alerts_last_30d_shelf": 0, "alerts_last_30d_wh": 0,
        "wh_reorder_point_qty": S.DEFAULT_REORDER_POINT, "pending_supplier_qty": 0,
    })
    weekday = F.weekday(F.lit(day))
    none = F.lit(None)
    return align_to_schema(wide.withColumns({
        "feature_date": F.lit(day), "day_of_week": weekday, "is_weekend": weekday >= 5,
        "warehouse_inbound_day": weekday.isin(*inbound_days), "refill_day": F.lit(False), "is_discounted": F.col("discount") > 0,
        "people_count": none.cast("int"),
        "stockout_events": F.when(F.col("current_stock_shelf") <= 0, 1).otherwise(0) if flag_stockout else F.lit(0),
        "shelf_fill_ratio": S.safe_ratio("current_stock_shelf", "shelf_capacity"),
        "warehouse_fill_ratio": S.safe_ratio("current_stock_warehouse", "warehouse_capacity"),
        "shelf_threshold_qty": none.cast("int"), "is_shelf_alert": F.lit(False),
        "is_warehouse_alert": (F.col("warehouse_capacity") > 0) & (F.col("current_stock_warehouse") < F.col("wh_reorder_point_qty")),
        "moved_wh_to_shelf": F.lit(0), "expired_qty_shelf": F.lit(0), "expired_qty_wh": F.lit(0), "batches_to_order": F.lit(0),
        "label_next_day_stockout": none.cast("boolean"),
    }), DAILY_FEATURES)


def upsert_features(table: DataFrame, fresh: DataFrame, now: Column) -> DataFrame:
    """Feature table after a run: rows of the same shelf and day are replaced and stamped."""
    keys = ["shelf_id", "feature_date"]
    body = {f.name: F.col(f"s.{f.name}") for f in DAILY_FEATURES if f.name not in keys}
    stamped = table if "snapshot_ts" in table.columns else table.withColumn("snapshot_ts", F.lit(None).cast("timestamp"))
    return upsert(stamped, fresh, keys, {**body, "snapshot_ts": now}, {**body, "snapshot_ts": now})


def backfill_label(features: DataFrame, day: Column) -> DataFrame:
    """Label of the day before: whether the shelf ran out on the day."""
    outcome = features.where(F.col("feature_date") == day).select(
        "shelf_id", F.date_sub("feature_date", 1).alias("feature_date"), (F.col("stockout_events") > 0).alias("_label")
    )
    joined = features.join(outcome, ["shelf_id", "feature_date"], "left")
    return joined.withColumn("label_next_day_stockout", F.coalesce("_label", "label_next_day_stockout")).select(*features.columns)


def _by_day():
    return W.partitionBy("shelf_id").orderBy("feature_date")


def _full_sum(column: str, rows: int) -> Column:
    """Sum of that many earlier rows, 0 until there are so many."""
    frame = _by_day().rowsBetween(-rows, -1)
    return F.when(F.count(F.lit(1)).over(frame) == rows, F.sum(column).over(frame)).otherwise(0)


def sales_lags(panel: DataFrame) -> DataFrame:
    return panel.withColumns({
        "sales_last_1d": F.lag("sales_qty", 1, 0).over(_by_day()).cast("int"),
        "sales_last_7d": _full_sum("sales_qty", 7).cast("int"),
        "sales_last_14d": _full_sum("sales_qty", 14).cast("int"),
    })


def alert_history(panel: DataFrame, column: str, out: str, alert_days: int = 30, by_rows: bool = True) -> DataFrame:
    """Alert count before the day: over the earlier rows of a 30-row span, or over the 30 days before."""
    if by_rows:
        frame = _by_day().rowsBetween(-(alert_days - 1), -1)
    else:
        frame = W.partitionBy("shelf_id").orderBy(F.unix_date("feature_date")).rangeBetween(-alert_days, -1)
    return panel.withColumn(out, F.coalesce(F.sum(flag(column)).over(frame), F.lit(0)).cast("int"))


def discount_ahead(panel: DataFrame, rows: int = 7) -> DataFrame:
    """Whether any of the next rows, this one included, has a discount."""
    frame = _by_day().rowsBetween(0, rows - 1)
    return panel.withColumn("is_discounted_next_7d", F.max(F.when(F.col("discount") > 0, 1).otherwise(0)).over(frame))


def next_day_label(panel: DataFrame) -> DataFrame:
    return panel.withColumn("label_next_day_stockout", F.coalesce(F.lead("stockout_events").over(_by_day()) > 0, F.lit(False)))


def panel_features(raw: DataFrame, alert_days: int = 30) -> DataFrame:
    """Lags, trailing sums, alert history, forward discount flag and label; one shuffle by shelf."""
    out = alert_history(sales_lags(raw), "is_shelf_alert", "alerts_last_30d_shelf", alert_days)
    if "is_warehouse_alert" in raw.columns:
        out = alert_history(out, "is_warehouse_alert", "alerts_last_30d_wh", alert_days)
    return next_day_label(discount_ahead(out))


def sales_next_7d() -> Column:
    """Sales of the seven days after the day, by date: a range frame instead of a self join."""
    frame = W.partitionBy("shelf_id").orderBy(F.unix_date("feature_date")).rangeBetween(1, 7)
    return F.coalesce(F.sum("sales_qty").over(frame), F.lit(0)).cast("int")


DEMAND_COLUMNS = (
    "shelf_id feature_date item_category item_subcategory day_of_week is_weekend refill_day item_price discount "
    "is_discounted is_discounted_next_7d people_count sales_last_1d sales_last_7d sales_last_14d current_stock_shelf "
    "shelf_capacity current_stock_warehouse warehouse_capacity standard_batch_size min_expiration_days "
    "avg_expiration_days qty_expiring_next_7d alerts_last_30d_shelf alerts_last_30d_wh"
).split()


def demand_next_7d(features: DataFrame, last_day: Column) -> DataFrame:
    """Training rows for weekly demand; the last seven days have no complete target and are left out."""
    rows = features.withColumn("y_sales_next_7d", sales_next_7d()).where(F.col("feature_date") <= F.date_sub(last_day, 7))
    return rows.select(*[c for c in DEMAND_COLUMNS if c in features.columns], "y_sales_next_7d")


def ml_features(features: DataFrame) -> DataFrame:
    """Numeric view of the feature table: flags as 0/1, gaps filled."""
    flags = ("is_weekend", "refill_day", "is_discounted", "is_discounted_next_7d", "is_shelf_alert", "is_warehouse_alert")
    zero = (
        "people_count sales_last_1d sales_last_7d sales_last_14d stockout_events shelf_capacity current_stock_shelf "
        "shelf_threshold_qty expired_qty_shelf alerts_last_30d_shelf warehouse_capacity current_stock_warehouse "
        "wh_reorder_point_qty pending_supplier_qty expired_qty_wh alerts_last_30d_wh moved_wh_to_shelf "
        "qty_expiring_next_7d batches_to_order"
    ).split()
    ratio = ("discount", "shelf_fill_ratio", "warehouse_fill_ratio")
    filled = {c: flag(c) for c in flags}
    filled |= {c: F.coalesce(F.col(c), F.lit(0)) for c in zero}
    filled |= {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ratio}
    filled |= {"item_price": F.col("item_price").cast("double"), "standard_batch_size": F.coalesce("standard_batch_size", F.lit(1))}
    filled |= {c: F.coalesce(F.col(c).cast("double"), F.lit(float(UNKNOWN_EXPIRY))) for c in ("min_expiration_days", "avg_expiration_days")}
    # The view has neither the day's own sales, nor the inbound flag, nor the stockout label.
    gone = ("sales_qty", "warehouse_inbound_day", "label_next_day_stockout")
    return features.select(*[filled.get(c, F.col(c)).alias(c) for c in DAILY_FEATURES.names if c not in gone])


def ml_train(features: DataFrame) -> DataFrame:
    return ml_features(features).where("warehouse_capacity > 0 and feature_date is not null")


def ml_score(features: DataFrame, day: Column, alerts_only: bool = True) -> DataFrame:
    rows = ml_features(features).where((F.col("feature_date") == day) & (F.col("warehouse_capacity") > 0))
    return rows.where("is_warehouse_alert = 1") if alerts_only else rows


def latest_feature_day(features: DataFrame, day: Column) -> DataFrame:
    """One row: the latest feature date not after the day."""
    return features.where(F.col("feature_date") <= day).agg(F.max("feature_date").alias("feature_date"))


def ewma(df: DataFrame, key: str, order: str, value: str, seed: Column, alpha: float = 0.1) -> DataFrame:
    """Smoothed demand per key after all days: e = (1 - alpha) e + alpha x from a seed.

    Written out, x of the k-th last day weighs alpha (1 - alpha)^(k-1) and the seed (1 - alpha)^n.
    """
    age = F.row_number().over(W.partitionBy(key).orderBy(F.desc(order))) - 1
    kept = 1.0 - alpha
    rows = df.withColumns({"_age": age, "_seed": seed})
    return rows.groupBy(key).agg(
        (F.sum(F.lit(alpha) * F.pow(F.lit(kept), F.col("_age")) * F.col(value))
         + F.pow(F.lit(kept), F.count(F.lit(1))) * F.max("_seed")).alias("demand_ewma")
    )
