"""Changing keyed tables by rewriting them: upsert, replacement, deletion, status changes."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import LIVE_STATUSES, alert_status
from .ordered import ordered_scan


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], on_match: dict[str, Column],
           on_insert: dict[str, Column] | None = None) -> DataFrame:
    """MERGE as one join. Expressions refer to the two sides as t.<col> and s.<col>.

    Both sides hold one row per key (aggregate the source first), so no key can skew the join.
    Without on_insert, source rows with a new key are dropped (update only).
    """
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = source.withColumn("_s", F.lit(True)).alias("s")
    same = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, same, "left" if on_insert is None else "full")
    both, new = F.col("t._t") & F.col("s._s"), F.col("t._t").isNull()
    out = []
    for f in target.schema.fields:
        c, old = f.name, F.col(f"t.{f.name}")
        if c in keys:
            value = F.coalesce(old, F.col(f"s.{c}"))
        else:
            value = F.when(both, on_match[c]) if c in on_match else None
            if on_insert is not None:
                fresh = on_insert.get(c, F.lit(None))
                value = F.when(new, fresh) if value is None else value.when(new, fresh)
            value = old if value is None else value.otherwise(old)
        out.append(value.cast(f.dataType).alias(c))
    return joined.select(*out)


def keep_newer(target: DataFrame, source: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """Source values win, but the time of a row never goes back; new keys are added."""
    values = {c: F.col(f"s.{c}") for c in source.columns if c not in keys}
    return upsert(target, source, keys, {**values, ts_col: F.greatest(f"t.{ts_col}", f"s.{ts_col}")}, values)


def replace_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose key is not incoming, plus all incoming rows."""
    kept = target.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def delete_keys(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Source rows whose key the target does not hold yet; null_safe lets a null key match a null key."""
    known = target.select(*keys).distinct().alias("k")
    s = source.alias("s")
    match = [
        F.col(f"s.{c}").eqNullSafe(F.col(f"k.{c}")) if null_safe else F.col(f"s.{c}") == F.col(f"k.{c}") for c in keys
    ]
    return s.join(known, match, "left_anti")


def exclude_recent(df: DataFrame, history: DataFrame, keys: Sequence[str], ts_col: str, now: Column,
                   minutes: int) -> DataFrame:
    """Rows whose key was not seen in the history within the last minutes (cooldown)."""
    if minutes <= 0:
        return df
    since = now - F.make_interval(mins=F.lit(minutes))
    recent = history.where(F.col(ts_col) >= since).select(*keys).distinct()
    return df.join(recent, list(keys), "left_anti")


def apply_status(alerts: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Alerts with status changes applied.

    alerts: alert_id, event_type, shelf_id, location, status, updated_at, ...
    changes: alert_id?, shelf_id, location, alert_event_type?, status, seq (total order).

    Changes apply in the order of seq. One that names the alert always counts. One for the place and type, or for the
    place alone, counts while the alert is live, so the first that closes it ends the row of them. What counts is therefore
    the last change that names the alert and, if that leaves it live, the changes for its place after that. Changes
    are reduced to one row per key before they meet the alerts; for an alert that was named, the next closing change
    after it is found in one ordered pass per place.
    """
    has = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    c = changes.withColumn("status", alert_status("status"))
    step = F.struct("seq", "status")
    by_id = c.where(has("alert_id")).groupBy("alert_id").agg(F.max(step).alias("by_id"))
    placed = c.where(~has("alert_id") & has("shelf_id") & has("location"))
    closes = ~F.col("status").isin(*LIVE_STATUSES)
    reduced = lambda df, p, *k: df.groupBy(*k).agg(
        F.min(F.when(closes, step)).alias(f"{p}_close"), F.max(step).alias(f"{p}_last")
    )
    of_type = placed.where(has("alert_event_type")).withColumn("event_type", F.col("alert_event_type"))
    of_place = placed.where(~has("alert_event_type"))
    typed = reduced(of_type, "typed", "shelf_id", "location", "event_type")
    untyped = reduced(of_place, "any", "shelf_id", "location")
    named = alerts.join(by_id, "alert_id").where(F.col("by_id.status").isin(*LIVE_STATUSES)).select(
        "alert_id", "shelf_id", "location", "event_type", F.col("by_id.seq").alias("seq"))

    def next_close(df: DataFrame, name: str, *keys: str) -> DataFrame:
        marks = named.select(*keys, "seq", F.lit(0).alias("_side"), "alert_id")
        line = marks.unionByName(df.select(*keys, "seq", F.lit(1).alias("_side"), F.when(closes, step).alias("_close")), allowMissingColumns=True)
        found = ordered_scan(line, keys, ["seq", "_side", "alert_id"], look_ahead={name: "_close"})
        return found.where("_side = 0").select("alert_id", name)

    joined = (
        alerts.join(by_id, "alert_id", "left")
        .join(typed, ["shelf_id", "location", "event_type"], "left")
        .join(untyped, ["shelf_id", "location"], "left")
        .join(next_close(of_type, "typed_next", "shelf_id", "location", "event_type"), "alert_id", "left")
        .join(next_close(of_place, "any_next", "shelf_id", "location"), "alert_id", "left")
    )
    was_named = F.col("by_id").isNotNull()
    base = F.coalesce(F.col("by_id.status"), F.col("status"))
    first = F.when(was_named, F.least("typed_next", "any_next")).otherwise(F.least("typed_close", "any_close"))
    last = F.greatest("typed_last", "any_last")
    last = F.when(~was_named | (last["seq"] > F.col("by_id.seq")), last)
    new = F.coalesce(F.when(base.isin(*LIVE_STATUSES), F.coalesce(first["status"], last["status"])), F.col("by_id.status"))
    return joined.withColumn("_new", new).withColumn("updated_at", F.when(F.col("_new").isNotNull(), now).otherwise(F.col("updated_at"))).withColumn(
        "status", F.coalesce("_new", "status")
    ).select(*alerts.columns)
