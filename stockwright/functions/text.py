"""Identifiers, statuses and other text."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from . import col

# Accepted alert statuses and the words that stand for them.
STATUS_WORDS = {
    "open": ("open", "active", "pending", "new"),
    "ack": ("ack", "acknowledged"),
    "resolved": ("resolved", "closed", "done"),
    "dismissed": ("dismissed", "ignored"),
}
LIVE_STATUSES = ("open", "ack")
ACTIVE_STATUSES = ("open", "active", "pending")
OPEN_PLAN_STATUSES = ("pending", "issued")


def clean_lower(c) -> Column:
    return F.lower(F.trim(col(c)))


def clean_upper(c) -> Column:
    return F.upper(F.trim(col(c)))


def alert_status(c) -> Column:
    """Status word to one of the four accepted statuses; anything else counts as acknowledged."""
    word = clean_lower(c)
    out = None
    for status, words in STATUS_WORDS.items():
        out = F.when(word.isin(*words), status) if out is None else out.when(word.isin(*words), status)
    return out.otherwise("ack")


def is_active(status) -> Column:
    return clean_lower(status).isin(*ACTIVE_STATUSES)


def is_open_plan(status) -> Column:
    return clean_lower(status).isin(*OPEN_PLAN_STATUSES)


def in_store(location) -> Column:
    place = clean_lower(F.coalesce(col(location), F.lit("")))
    return place.contains("store") | place.contains("shop")


def in_warehouse(location) -> Column:
    place = clean_lower(F.coalesce(col(location), F.lit("")))
    return place.contains("warehouse") | place.startswith("wh")


def compound_key(*parts, sep: str = "::") -> Column:
    return F.concat_ws(sep, *[col(p).cast("string") for p in parts])


def supplier_lot(shelf, day) -> Column:
    return F.concat(F.lit("SUP-"), F.date_format(col(day), "yyyyMMdd"), F.lit("-"), col(shelf), F.lit("-1"))


def numbered_lot(n) -> Column:
    return F.format_string("B%07d", col(n).cast("bigint"))


def one_of(c, allowed: Iterable[str]) -> Column:
    """Null outside the allowed values."""
    return F.when(col(c).isin(*allowed), col(c))
