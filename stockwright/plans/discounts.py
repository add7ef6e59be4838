"""Near-expiry discounts, weekly promotions, prices on a date."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import money as M
from ..functions.times import iso_week, week_days


def expiring(lots: DataFrame, today: Column) -> DataFrame:
    """Distinct (shelf, expiry) of stocked lots that expire today or tomorrow."""
    soon = F.col("expiry_date").between(today, F.date_add(today, 1))
    return lots.where((F.col("batch_quantity_store") > 0) & soon).select("shelf_id", "expiry_date").distinct()


def discount_days(lots: DataFrame, today: Column) -> DataFrame:
    """(shelf, discount date): today for both, and tomorrow too for lots that expire tomorrow."""
    tomorrow = F.date_add(today, 1)
    days = F.when(F.col("expiry_date") == tomorrow, F.array(today, tomorrow)).otherwise(F.array(today))
    return expiring(lots, today).select("shelf_id", F.explode(days).alias("discount_date")).distinct()


def daily_discount(lots: DataFrame, existing: DataFrame, today: Column, now: Column,
                   levels: Sequence[float] = M.EXTRA_DISCOUNTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new discount rows, whole discount table, alerts).

    The extra discount compounds with the base discount of the shelf and date. Rows this job wrote
    itself (source 'expiry') are no base, so running it twice gives the same table.
    """
    own = F.col("source") == "expiry" if "source" in existing.columns else F.lit(False)
    base = existing.where(~F.coalesce(own, F.lit(False))).groupBy("shelf_id", "discount_date").agg(F.max("discount").alias("base"))
    extra = M.extra_discount("shelf_id", "discount_date", levels)
    fresh = discount_days(lots, today).join(base, ["shelf_id", "discount_date"], "left").select(
        "shelf_id", "discount_date",
        M.compound(F.coalesce(F.col("base"), F.lit(0.0)), extra).alias("discount"), now.alias("created_at"),
    )
    rows = fresh.withColumn("source", F.lit("expiry")) if "source" in existing.columns else fresh
    kept = existing.where(~F.coalesce(own, F.lit(False))) if "source" in existing.columns else existing.join(
        fresh.select("shelf_id", "discount_date"), ["shelf_id", "discount_date"], "left_anti"
    )
    if "source" in existing.columns:
        old = existing.where(own).join(fresh.select("shelf_id", "discount_date"), ["shelf_id", "discount_date"], "left_anti")
        kept = kept.unionByName(old)
    alerts = fresh.select("shelf_id").distinct().select(
        F.lit("near_expiry_discount").alias("event_type"), "shelf_id", F.lit("store").alias("location"), now.alias("created_at")
    )
    return fresh, kept.unionByName(rows, allowMissingColumns=True), alerts


def weekly_to_daily(weekly: DataFrame) -> DataFrame:
    """Weekly promotions as one row per shelf and day; overlaps keep the largest discount."""
    days = weekly.select("shelf_id", F.explode(week_days("week_start", "week_end")).alias("discount_date"),
                         M.as_fraction("discount_pct").alias("discount"))
    return days.groupBy("shelf_id", "discount_date").agg(F.max("discount").alias("discount"))


def discount_on(weekly: DataFrame, day: Column) -> DataFrame:
    """Largest promotion per shelf whose week covers a day, both ends included."""
    live = weekly.where(F.lit(day).between(F.col("week_start"), F.col("week_end")))
    return live.groupBy("shelf_id").agg(F.max(M.as_fraction("discount_pct")).alias("discount"))


def discount_in_week(weekly: DataFrame, day: Column, week: str = "week") -> DataFrame:
    """Largest promotion per shelf of the ISO week a day lies in, for tables that name the week."""
    live = weekly.where(F.col(week) == iso_week(F.lit(day)))
    return live.groupBy("shelf_id").agg(F.max(M.as_fraction("discount_pct")).alias("discount"))


def effective(promo: DataFrame, fixed: DataFrame, mode: str = "max") -> DataFrame:
    """Promo and fixed discounts per shelf and day combined; days without a discount are left out."""
    p = promo.select("shelf_id", "discount_date", F.col("discount").alias("_p"))
    f = fixed.select("shelf_id", "discount_date", F.col("discount").alias("_f"))
    both = p.join(f, ["shelf_id", "discount_date"], "full")
    return both.select("shelf_id", "discount_date", M.effective_discount("_p", "_f", mode).alias("discount")).where("discount > 0")


def discounted_next(daily: DataFrame, day: Column, days: int = 7) -> DataFrame:
    """Shelves with any discount from the day on, for a number of days."""
    window = F.col("discount_date").between(day, F.date_add(day, days - 1))
    return daily.where(window & (F.col("discount") > 0)).select("shelf_id").distinct().withColumn("is_discounted_next_7d", F.lit(True))
