"""The steps of streams with timers, driven by hand: rows, watermark and timers."""
import json

import pandas as pd
import pytest

from stockwright.streaming import timed

M = timed.MINUTE


class State:
    """What a step sees of Spark's state: value, watermark, timer."""

    def __init__(self):
        self.value, self.timer, self.now, self.hasTimedOut = None, None, 0, False

    exists = property(lambda s: s.value is not None)
    get = property(lambda s: s.value)

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.now // 1000

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):  # noqa: N802
        assert ms * 1000 > self.now
        self.timer = ms * 1000


def call(step, key, state, rows=None, now=None):
    """One batch with rows, or the timer if the watermark has passed it."""
    if now is not None:
        state.now = now
    state.hasTimedOut = rows is None
    if state.hasTimedOut:
        if state.timer is None or state.timer >= state.now:
            return []
        state.timer = None
    out = [tuple(r) for f in step(key, iter([pd.DataFrame(rows or [])] if rows else []), state) for r in f.itertuples(index=False)]
    if state.value is not None:
        json.loads(state.value[0])
    return out


def move(t, item, step, place=(0.0,)):
    return {"t": t, "visit_id": None, "checkout_us": None, "item_id": item, "step": step, "place": list(place)}


def visit(t, name, left):
    return {"t": t, "visit_id": name, "checkout_us": left, "item_id": None, "step": None, "place": None}


def test_checkout_over_batches_and_returning_customer():
    s, go = State(), lambda rows, now: call(timed.checkout_step, ("c",), s, rows, now)
    assert go([move(12, "a", 3), visit(10, "v1", 50), move(11, "a", -2), move(5, "a", 9)], 0) == []
    assert go([visit(10, "v1", 50), move(40, "b", 2), move(51, "b", 7), visit(60, "v2", 90), move(61, "a", 1)], 30) == []
    assert call(timed.checkout_step, ("c",), s, now=50) == []
    assert sorted(call(timed.checkout_step, ("c",), s, now=2000)) == [("c", "v1", 50, "a", 3), ("c", "v1", 50, "b", 2), ("c", "v2", 90, "a", 1)]
    assert go([move(70, "a", 1)], 3000) == []  # its visit is over


def test_quantity_stops_at_zero_in_the_order_of_place():
    s = State()
    rows = [visit(0, "v", 5), move(1, "a", 4, (2.0,)), move(1, "a", -3, (1.0,)), move(2, "a", -1)]
    assert call(timed.checkout_step, ("c",), s, rows, 0) == []
    assert call(timed.checkout_step, ("c",), s, now=2000) == [("c", "v", 5, "a", 3)]


def test_visits_without_checkout_hold_their_events_back():
    s = State()
    assert call(timed.checkout_step, ("c",), s, [visit(0, "v1", None), move(1, "a", 4), visit(10, "v2", 20), move(12, "a", 1)], 0) == []
    assert call(timed.checkout_step, ("c",), s, now=2000) == [("c", "v2", 20, "a", 1)]


def exit_row(ts, qty=5, due=None):
    return {"shelf_id": "s", "batch_code": None, "qty": qty, "item_weight": 2.0, "ts_us": ts, "due_us": due or ts + 3 * M}


def test_refill_is_sent_once():
    s, step = State(), timed.refill_step(60 * M)
    assert call(step, ("e",), s, [exit_row(10 * M), exit_row(10 * M)], 0) == []
    assert call(step, ("e",), s, [exit_row(11 * M, qty=7)], 10 * M) == []  # the later version counts
    assert call(step, ("e",), s, now=14 * M) == [("e", "s", None, 7, 2.0, 11 * M)]
    assert call(step, ("e",), s, [exit_row(10 * M)], 20 * M) == []
    assert call(step, ("e",), s, now=200 * M) == [] and s.value is None


def test_refill_that_arrives_late_is_sent_at_once():
    s = State()
    assert call(timed.refill_step(60 * M), ("e",), s, [exit_row(10 * M)], 500 * M) == [("e", "s", None, 5, 2.0, 10 * M)]


@pytest.mark.parametrize("later, passes", [(30, False), (60, False), (61, True)])
def test_cooldown(later, passes):
    s, step, key = State(), timed.cooldown_step(60 * M), ("t", "s", "store")
    at = lambda m: {"created_us": 1000 * M + m * M}
    assert call(step, key, s, [at(0), at(0)], 0) == [(*key, 1000 * M)]
    assert call(step, key, s, [at(10)], 1000 * M) == []
    assert call(step, key, s, [at(later)], 1010 * M) == ([(*key, 1000 * M + later * M)] if passes else [])
    assert call(step, key, s, now=1200 * M) == [] and s.value is None
