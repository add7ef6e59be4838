"""Quantities: fill level, targets, batch rounding, reorder points, order sizes."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import col, lit

DEFAULT_THRESHOLD_PCT = 30.0
DEFAULT_MIN_QTY = 1
DEFAULT_TARGET_PCT = 80.0
DEFAULT_REORDER_POINT = 10

# Demand multiplier per item category, and the one for any other category.
CATEGORY_DEMAND = {
    "BEVERAGES": 1.15,
    "BEERS": 1.05,
    "WINES": 0.85,
    "SPIRITS AND APERITIFS": 0.55,
    "FRUITS AND VEGETABLES": 1.20,
    "REFRIGERATED": 1.00,
    "FROZEN": 0.75,
    "MEAT": 0.85,
    "FISH": 0.60,
    "BATH AND PERSONAL CARE": 0.50,
    "HOUSEHOLD GOODS": 0.45,
    "LAUNDRY PRODUCTS": 0.40,
    "HOUSE CLEANING PRODUCTS": 0.45,
    "BABY PRODUCTS": 0.35,
    "SWEETS AND BREAKFAST": 0.95,
    "PASTA AND RICE": 0.80,
    "FLOURS AND SUGAR": 0.60,
    "HOT BEVERAGES": 0.55,
    "SAUCES": 0.55,
    "PASTA SAUCES": 0.65,
    "SPICES": 0.35,
    "VINEGAR AND OIL": 0.45,
    "SAVORY SNACKS": 0.90,
    "PET PRODUCTS": 0.50,
    "CANNED GOODS": 0.70,
    "LONG-LIFE DAIRY": 0.75,
    "LONG-LIFE FRUIT": 0.55,
    "GLUTEN FREE": 0.40,
    "BREAD AND BREADSTICKS": 0.70,
}
OTHER_CATEGORY_DEMAND = 0.60


def stock_pct(stock, capacity) -> Column:
    """Fill level in percent; null when the capacity is unknown or not positive."""
    cap = col(capacity)
    return F.when(cap > 0, col(stock) * 100.0 / cap)


def target_qty(capacity, pct=DEFAULT_TARGET_PCT) -> Column:
    return F.ceil(col(capacity) * lit(pct) / 100.0)


def shortfall(wanted, stock) -> Column:
    return F.greatest(F.lit(0), col(wanted) - col(stock))


def suggested_qty(stock, capacity, min_qty, pct=DEFAULT_TARGET_PCT) -> Column:
    """Gap to the fill target, or to the minimum quantity where no capacity is known."""
    return F.when(col(capacity).isNotNull(), shortfall(target_qty(capacity, pct), stock)).otherwise(
        shortfall(min_qty, stock)
    )


def needs_refill(stock, pct, threshold, min_qty) -> Column:
    """Below the percent threshold (when the percent is known) or below the minimum quantity."""
    return F.coalesce(col(pct) < col(threshold), F.lit(False)) | (col(stock) < col(min_qty))


def round_up_to_batch(qty, batch, multiplier: int = 1) -> Column:
    """Smallest multiple of batch x multiplier that covers qty; qty itself without a usable batch."""
    q, step = col(qty), col(batch) * F.lit(multiplier)
    return F.when(step > 0, q + F.pmod(-q, step)).otherwise(q)


def capacity_in_batches(base, batch, up: bool, min_batches: int = 2) -> Column:
    """Capacity as whole batches, rounded up or down, never below the minimum number of batches."""
    size = col(batch)
    floor = F.lit(min_batches) * size
    raw = F.greatest(col(base), floor)
    return raw + F.pmod(-raw, size) if up else raw - F.pmod(raw, size)


def safe_ratio(num, den) -> Column:
    d = col(den)
    return F.when(d > 0, col(num).cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def reorder_point(maximum, current, share: str = "0.05") -> Column:
    """Share of the capacity, rounded half up, at least one. Decimal so that .5 is exact."""
    base = F.coalesce(col(maximum), col(current)).cast("decimal(18,0)")
    return F.greatest(F.lit(1), F.round(base * F.lit(share).cast("decimal(6,4)"), 0).cast("int"))


def cover_qty(daily_demand, days) -> Column:
    return F.ceil(col(daily_demand) * lit(days))


def category_demand(category) -> Column:
    pairs = [F.lit(x) for kv in CATEGORY_DEMAND.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(category)), F.lit(OTHER_CATEGORY_DEMAND))


def base_daily_demand(capacity, price, multiplier) -> Column:
    """Expected units a day: grows with the shelf, falls with a price above 2, at least 0.2."""
    dampening = 1.0 + 0.10 * F.greatest(col(price) - 2.0, F.lit(0.0))
    return F.greatest(F.lit(0.2), 0.03 * col(capacity) / dampening * lit(multiplier))


def season_factor(day) -> Column:
    month = F.month(col(day))
    return F.when(month.isin(6, 7, 8), 1.10).when(month == 12, 1.15).otherwise(1.0)


def weekend_factor(day) -> Column:
    return F.when(F.weekday(col(day)) >= 5, 1.10).otherwise(1.0)


def order_qty(stock, pending, reorder_at, demand, batch, capacity, cover_days: int = 14) -> Column:
    """Order up to the cover target in whole batches, capped by the free capacity."""
    future = col(stock) + col(pending)
    gap = F.greatest(F.lit(0), cover_qty(demand, cover_days) - future)
    free = F.greatest(F.lit(0), col(capacity) - future)
    return F.when(future < col(reorder_at), F.least(round_up_to_batch(gap, batch), free)).otherwise(F.lit(0))


def deliverable(pending, capacity, stock) -> Column:
    """The part of a pending order that fits; the rest stays pending."""
    return F.least(col(pending), F.greatest(F.lit(0), col(capacity) - col(stock)))


def fallback_batches(stock, reorder_at, capacity, in_alert, batch) -> Column:
    """Whole batches from current stock to the reorder point, within the free capacity.

    A shelf in alert whose reorder point is not above its stock is treated as one batch short.
    """
    size = F.greatest(F.lit(1), F.coalesce(col(batch), F.lit(1)))
    now = F.coalesce(col(stock), F.lit(0))
    point = F.coalesce(col(reorder_at), F.lit(0))
    cap = F.coalesce(col(capacity), F.lit(0))
    point = F.when((col(in_alert) == 1) & (point <= now), now + size).otherwise(point)
    wanted = round_up_to_batch(F.greatest(F.lit(0), point - now), size)
    fits = F.when(cap > 0, F.greatest(F.lit(0), cap - now)).otherwise(wanted)
    return F.floor(F.least(wanted, fits) / size).cast("int")
