"""Operational reports."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean_lower, clean_upper, in_store, in_warehouse, is_active
from ..functions.times import day_part
from ..operators.latest import latest_slice

TIME_COLUMNS = ("event_ts", "event_time", "timestamp", "ts", "created_at", "time")
CANCELLED = ("canceled", "cancelled")


def occupancy(visits: DataFrame, now: Column) -> DataFrame:
    """People in the store: entered within a day and not left yet. Without exit times all who entered count."""
    inside = F.col("entry_time").between(now - F.make_interval(days=F.lit(1)), now)
    if "exit_time" in visits.columns:
        inside = inside & (F.col("exit_time").isNull() | (F.col("exit_time") > now))
    return visits.where(inside).agg(F.count(F.lit(1)).alias("inside"))


def people_on(features: DataFrame, day: Column) -> DataFrame:
    return features.where(F.col("feature_date") == day).groupBy("feature_date").agg(
        F.coalesce(F.max("people_count"), F.lit(0)).alias("people_count")
    )


def active_alerts(alerts: DataFrame) -> DataFrame:
    """Active alerts with the place they belong to: store, warehouse, or other."""
    place = F.when(in_store("location"), "store").when(in_warehouse("location"), "warehouse").otherwise("other")
    return alerts.where(is_active("status")).withColumn("place", place)


def alerts_by_place(alerts: DataFrame) -> DataFrame:
    return active_alerts(alerts).groupBy("place").agg(
        F.count(F.lit(1)).alias("alerts"), F.countDistinct("shelf_id").alias("shelves")
    )


def with_category(df: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rows with the category and subcategory of their shelf."""
    return df.join(inventory.select("shelf_id", "item_category", "item_subcategory"), "shelf_id", "left")


def store_alerts_by_category(alerts: DataFrame, inventory: DataFrame) -> DataFrame:
    """Active store alerts per category and shelf."""
    per_shelf = active_alerts(alerts).where(in_store("location")).groupBy("shelf_id").agg(F.count(F.lit(1)).alias("alerts"))
    return with_category(per_shelf, inventory).select(clean_upper("item_category").alias("item_category"), "shelf_id", "alerts")


def red_categories(alerts: DataFrame, inventory: DataFrame) -> DataFrame:
    return store_alerts_by_category(alerts, inventory).where("item_category is not null").select("item_category").distinct()


def order_dates(orders: DataFrame, now: Column) -> DataFrame:
    """One row: next and last order time and the column they come from.

    The first of delivery_ts, cutoff_ts, delivery_date with any value decides, also when it holds
    no future value. Cancelled orders do not count.
    """
    live = orders.where(~clean_lower("status").isin(*CANCELLED)) if "status" in orders.columns else orders
    cols = [c for c in ("delivery_ts", "cutoff_ts", "delivery_date") if c in orders.columns]
    aggs = []
    for c in cols:
        t = F.col(c).cast("timestamp")
        floor = F.to_date(now).cast("timestamp") if c == "delivery_date" else now
        aggs += [F.max(t).alias(f"last_{c}"), F.min(F.when(t >= floor, t)).alias(f"next_{c}")]
    one = live.agg(*aggs)
    pick = lambda v: reduce(lambda acc, c: acc.when(F.col(f"last_{c}").isNotNull(), v(c)), cols, F.when(F.lit(False), v(cols[0])))
    return one.select(
        pick(lambda c: F.col(f"next_{c}")).alias("next_order"), pick(lambda c: F.col(f"last_{c}")).alias("last_order"),
        pick(F.lit).alias("source"),
    )


def restock_rows(events: DataFrame) -> DataFrame:
    """wh_in events of the last restock day: by event time, else by received date."""
    rows = events.where("event_type = 'wh_in'")
    day = F.coalesce(F.to_date("ts"), F.lit(None).cast("date"))
    last_ts, last_received = rows.agg(F.max(day)).scalar(), rows.agg(F.max("received_date")).scalar()
    of_day = F.when(last_ts.isNotNull(), day == last_ts).otherwise(F.col("received_date") == last_received)
    return rows.where(of_day)


def restock_day(events: DataFrame) -> DataFrame:
    return restock_rows(events).agg(
        F.max(F.coalesce(F.to_date("ts"), F.col("received_date"))).alias("restock_day"), F.max("ts").alias("restock_ts"),
        F.sum("qty").alias("items"), F.countDistinct("shelf_id").alias("shelves"),
    )


def prediction_kpis(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("shelf_id").alias("shelves"), F.sum("suggested_qty").alias("total_qty"),
        F.max("feature_date").alias("latest_feature_date"),
    )


def narrow(df: DataFrame, category: str | None = None, subcategory: str | None = None, shelf: str | None = None,
           since: Column | None = None, until: Column | None = None, status: str | None = None, model: str | None = None,
           day: str = "feature_date") -> DataFrame:
    """Rows that meet the given criteria; criteria that are not given, or whose column is absent, do not narrow."""
    tests = [
        ("item_category", category, lambda v: clean_upper("item_category") == v.strip().upper()),
        ("item_subcategory", subcategory, lambda v: F.trim("item_subcategory") == v),
        ("shelf_id", shelf, lambda v: F.trim("shelf_id") == v),
        (day, since, lambda v: F.col(day) >= v),
        (day, until, lambda v: F.col(day) <= v),
        ("status", status, lambda v: F.col("status") == v),
        ("model_name", model, lambda v: F.col("model_name") == v),
    ]
    for column, value, test in tests:
        if value is not None and column in df.columns:
            df = df.where(test(value))
    return df


def topk(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows of an order; each task keeps n rows, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def recent_rows(df: DataFrame, n: int) -> DataFrame:
    """Newest rows by the first time column the table has, else by its first column."""
    by = next((c for c in TIME_COLUMNS if c in df.columns), df.columns[0])
    rest = [c for c in df.columns if c != by]
    return topk(df, [F.desc_nulls_last(by), *rest], n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def latest_rows(df: DataFrame, ts_col: str) -> DataFrame:
    return latest_slice(df, ts_col)


def entry_exit(visits: DataFrame) -> DataFrame:
    """Each visit as two rows, its entry and, once known, its exit."""
    moves = F.array(
        F.struct(F.lit("entry").alias("event_type"), F.col("entry_time").alias("time")),
        F.struct(F.lit("exit").alias("event_type"), F.col("exit_time").alias("time")),
    )
    rows = visits.select("customer_id", F.date_format("entry_time", "EEEE").alias("weekday"),
                         day_part("entry_time").alias("time_slot"), F.explode(moves).alias("m"))
    return rows.select("m.event_type", "customer_id", "m.time", "weekday", "time_slot").where("time is not null")
