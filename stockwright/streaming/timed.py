"""Streams with keyed state and event-time timers, held by Spark's own state store.

Each step sees the new rows and the state of one key, or of a bucket of keys (`together`), and is called again when the watermark passes its timer; so progress,
state and output are committed together and a stream that is stopped goes on where it was. Plain Python handles the rows
of a key (Spark's built-in operators have no timer); state is small JSON text.
"""
from __future__ import annotations

import json
import sys
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.alerts import ALERT_KEY
from ..plans.planning import refill_queue, shelf_events_of
from ..plans.sales import cart_events, checkout_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE = 60_000_000  # in microseconds, as all times here
EVENT_TIME = GroupStateTimeout.EventTimeTimeout


def micros(c: str | Column) -> Column:
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def watermark(state: GroupState) -> int:
    return state.getCurrentWatermarkMs() * 1000


def remembered(state: GroupState, empty: dict | None) -> dict | list | None:
    return json.loads(state.get[0]) if state.exists else empty


def remember(state: GroupState, data: dict | list, timer: int | None) -> None:
    """Keeps the data and wakes the key once the watermark has reached the timer."""
    state.update((json.dumps(data),))
    if timer is not None:
        state.setTimeoutTimestamp(max((timer - 1) // 1000, state.getCurrentWatermarkMs() + 1))


def records(frames) -> Iterator[tuple]:
    for frame in frames:
        yield from frame.itertuples(index=False)


CHECKOUT = "customer_id string, visit_id string, checkout_us bigint, item_id string, quantity bigint"


def checkout_step(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
    now, data = watermark(state), remembered(state, {"visits": {}, "events": [], "carts": {}})
    visits, carts = data["visits"], data["carts"]
    for r in records(frames) if not state.hasTimedOut else ():
        if r.visit_id is not None:
            visits.setdefault(r.visit_id, [int(r.t), None if pd.isna(r.checkout_us) else int(r.checkout_us), False])
        else:
            data["events"].append([int(r.t), list(map(float, r.place)), r.item_id, int(r.step)])
    line = sorted((entry, name, left, over) for name, (entry, left, over) in visits.items())
    entries = [row[0] for row in line]
    settled = sorted(e for e in data["events"] if e[0] < now)  # nothing that comes before them is still on its way
    data["events"] = [e for e in data["events"] if e[0] >= now]
    for t, _, item, step in settled:
        at = bisect_right(entries, t) - 1
        if at < 0 or line[at][2] is None or t > line[at][2] or line[at][3]:
            continue
        cart = carts.setdefault(line[at][1], {}).setdefault(item, [0, None])
        cart[0] += step
        cart[1] = cart[0] if cart[1] is None else min(cart[0], cart[1])
    ended = [(name, left) for _, name, left, _ in line if left is not None and left < now]
    for name, _ in ended:
        visits[name][2] = True
    out = [(key[0], name, left, item, n) for name, left in ended for item, (net, low) in carts.pop(name, {}).items() if (n := max(net, net - low, 0)) > 0]
    last = bisect_right(entries, now) - 1  # later events may still fall on the last visit that has begun
    for at, (_, name, left, _) in enumerate(line):
        if at < last and (left is None or left < now):
            del visits[name]
    open_ = [left for _, left, _ in visits.values() if left is not None and left >= now]
    remember(state, data, min(open_) + 1 if open_ else None)
    yield pd.DataFrame(out, columns=["customer_id", "visit_id", "checkout_us", "item_id", "quantity"])


def checkout_stream(events: DataFrame, visits: DataFrame, now: Column, order: list[str], max_age_h: int = 3, delay: str = "0 seconds") -> DataFrame:
    """Carts of finished visits: customer_id, visit_id, checkout_ts, item_id and quantity, each visit once.

    Both inputs are streams. An event belongs to the latest visit of its customer that had begun; it counts up to the
    checkout, in the order of time and of the (numeric) order columns, and a quantity never falls below zero. A visit is
    closed when the watermark has passed its checkout. A visit delivered again counts once; an event later than the
    watermark counts while its visit is open, at the time of its arrival, and not at all once the visit is closed. State
    per customer: the open visits, their quantities, and the events newer than the watermark.
    """
    moves = cart_events(events).select("ts", "customer_id", micros("ts").alias("t"), F.lit(None).cast("string").alias("visit_id"), F.lit(None).cast("bigint").alias("checkout_us"),
                                       "item_id", F.col("_step").cast("bigint").alias("step"), F.array(*[F.col(c).cast("double") for c in order]).alias("place"))
    left = checkout_time(F.col("entry_time"), F.col("exit_time"), now, max_age_h)
    starts = visits.where("customer_id is not null and visit_id is not null and entry_time is not null").select(
        F.col("entry_time").alias("ts"), "customer_id", micros("entry_time").alias("t"), F.col("visit_id").cast("string"), micros(left).alias("checkout_us"),
        F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("bigint").alias("step"), F.lit(None).cast("array<double>").alias("place"))
    both = moves.unionByName(starts).withWatermark("ts", delay)
    out = both.groupBy("customer_id").applyInPandasWithState(checkout_step, CHECKOUT, "data string", "append", EVENT_TIME)
    return out.withColumn("checkout_ts", F.timestamp_micros("checkout_us")).drop("checkout_us")


#: What a rule sees: its key's data or None, the new rows, the watermark, and whether the timer called; gives data or None, output, timer.
Rule = Callable[[list | None, list[tuple], int, bool], tuple[list | None, list[tuple], int | None]]
BUCKETS = 1024


def names_of(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def known(value):
    return None if value != value else value  # pandas' NaN and NaT differ from themselves


def alone(rule: Rule, fields: list[str], schema: str):
    """The rule as a step whose group is one key."""

    def step(key, frames, state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [tuple(known(getattr(r, f)) for f in fields) for r in records(frames)] if not state.hasTimedOut else []
        data, out, timer = rule(remembered(state, None), rows, watermark(state), state.hasTimedOut)
        if data is None:
            state.remove()
        else:
            remember(state, data, timer)
        yield pd.DataFrame([(*key, *r) for r in out], columns=names_of(schema))

    return step


def together(rule: Rule, keys: list[str], fields: list[str], schema: str):
    """The rule as a step whose group is a bucket of many keys; each key has its own data and timer (in milliseconds), as if it
    were alone: it is called with its rows, or without any once the watermark has passed its timer. A call costs about a
    millisecond, so keys that are many and have a few rows each share one. State: compressed JSON text, by key."""

    def step(bucket, frames, state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(zlib.decompress(state.get[0])) if state.exists else {}
        now, now_ms, new, out = watermark(state), state.getCurrentWatermarkMs(), {}, []
        for frame in frames if not state.hasTimedOut else ():
            columns = [[known(v) for v in frame[c].tolist()] for c in (*keys, *fields)]
            for row in zip(*columns):
                new.setdefault(json.dumps(row[:len(keys)]), []).append(row[len(keys):])
        due = [name for name, (timer, _) in held.items() if timer is not None and timer < now_ms and name not in new]
        for name in (*new, *due):
            data, made, timer = rule(held[name][1] if name in held else None, new.get(name, []), now, name not in new)
            if data is None:
                held.pop(name, None)
            else:
                held[name] = [None if timer is None else max((timer - 1) // 1000, now_ms + 1), data]
            out += [(*json.loads(name), *r) for r in made]
        if held:
            state.update((zlib.compress(json.dumps(held, separators=(",", ":")).encode(), 1),))
            timers = [timer for timer, _ in held.values() if timer is not None]
            if timers:
                state.setTimeoutTimestamp(min(timers))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=names_of(schema))

    return step


def by_bucket(rows: DataFrame, rule: Rule, keys: list[str], fields: list[str], schema: str, buckets: int = BUCKETS) -> DataFrame:
    """The rule over all keys of a stream, in a number of buckets that must stay the same for a checkpoint."""
    grouped = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))).groupBy("_bucket")
    return grouped.applyInPandasWithState(together(rule, keys, fields, schema), schema, "data binary", "append", EVENT_TIME)


REFILL = "event_id string, shelf_id string, batch_code string, qty int, item_weight double, ts_us bigint"
REFILL_ROW = ["shelf_id", "batch_code", "qty", "item_weight", "ts_us", "due_us"]


def refill_rule(span: int) -> Rule:
    """Data: due time and, while it waits, the row."""

    def rule(data, rows, now, timed_out):
        due, row = data or (None, None)
        waits = data is None or row is not None
        for shelf, batch, qty, weight, at, arrives in rows:
            if waits and (row is None or at >= row[-1]):
                row, due = [shelf, batch, int(qty), weight, int(at)], int(arrives)
        out = []
        if waits and due <= now:
            out, waits = [tuple(row)], False
        if waits:
            return [due, row], out, due
        return (None if due + span <= now and timed_out else [due, None]), out, due + span

    return rule


def refill_step(span: int):
    return alone(refill_rule(span), REFILL_ROW, REFILL)


def refill_stream(wh_out: DataFrame, profiles: DataFrame, delay_min: int = 3, remember_days: int = 1) -> DataFrame:
    """Warehouse exits as shelf events once the latest event time has passed their arrival; late ones at once.

    An exit is known by its event_id. Delivered again while it waits, the version with the later time counts; delivered
    again after that, it is ignored for so many days of event time, and then taken for a new one. State: one entry per exit.
    """
    queue = refill_queue(wh_out, profiles, delay_min).withColumns({"ts_us": micros("ts"), "due_us": micros("available_at")})
    out = by_bucket(queue.withWatermark("ts", "0 seconds"), refill_rule(remember_days * 1440 * MINUTE), ["event_id"], REFILL_ROW, REFILL)
    return shelf_events_of(out.withColumn("ts", F.timestamp_micros("ts_us")).drop("ts_us"))


COOLED = "event_type string, shelf_id string, location string, created_us bigint"


def cooldown_rule(span: int) -> Rule:
    """Data: the time of the last alert let through."""

    def rule(data, rows, now, timed_out):
        if timed_out:
            return None, [], None
        last, out = data[0] if data else None, []
        for t in sorted({int(t) for (t,) in rows}):
            if last is None or t - last > span:
                last = t
                out.append((t,))
        return (None if last is None else [last]), out, None if last is None else last + span + 1

    return rule


def cooldown_step(span: int):
    return alone(cooldown_rule(span), ["created_us"], COOLED)


def cooled_alerts(alerts: DataFrame, minutes: int = 60) -> DataFrame:
    """Alerts (type, place and created_at) that were not already raised, and let through, within the last minutes.

    Alerts of one type, place and time are the same one, however often they arrive. The state, the time of the last alert
    let through, is forgotten when the watermark has passed its span.
    """
    rows = alerts.select(*ALERT_KEY, "created_at", micros("created_at").alias("created_us")).withWatermark("created_at", "0 seconds")
    out = by_bucket(rows, cooldown_rule(minutes * MINUTE), list(ALERT_KEY), ["created_us"], COOLED)
    return out.withColumn("created_at", F.timestamp_micros("created_us")).drop("created_us")
