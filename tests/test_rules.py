"""One small case per rule that is easy to get wrong."""
import uuid

import pytest
from helpers import day, frame, rows, ts
from pyspark.sql import functions as F

from stockwright.functions import ids, money as M, stock as S, text as X, times as T
from stockwright.operators import align, latest, merge
from stockwright.plans import alerts as A, config, discounts as D, features as FX, inventory as inv, ml, planning as P, reports as R

EVENTS = "shelf_id string, event_type string, quantity int, ts timestamp"
STATE = "shelf_id string, current_stock int, item_weight double, last_update_ts timestamp"
POLICY = "shelf_id string, threshold_pct double, min_qty int, active boolean, updated_at date"
LOTS = "shelf_id string, batch_code string, received_date date, expiry_date date, batch_quantity_store int, last_update_ts timestamp"


def test_no_global_policy_uses_defaults(spark):
    shelves = frame(spark, "shelf_id string", ("S1",), ("S2",))
    p = frame(spark, POLICY, ("S1", 50.0, 3, True, "1998-01-01"))
    assert rows(A.resolve_policy(shelves, p)) == [("S1", 50.0, 3), ("S2", 30.0, 1)]


def test_global_policy_covers_the_rest(spark):
    shelves = frame(spark, "shelf_id string", ("S1",), ("S2",))
    p = frame(spark, POLICY, ("S1", 50.0, None, True, "1998-01-01"), (None, 10.0, 7, True, "1998-01-01"))
    assert rows(A.resolve_policy(shelves, p)) == [("S1", 50.0, 7), ("S2", 10.0, 7)]


def test_newer_inactive_policy_hides_the_older(spark):
    p = frame(spark, POLICY, ("S1", 50.0, 3, True, "1998-01-01"), ("S1", 60.0, 4, False, "1998-02-01"))
    assert rows(config.latest_policies(p)) == []


def test_policy_levels_by_category(spark):
    shelves = frame(spark, "shelf_id string, item_category string, item_subcategory string", ("S1", "c", "s"), ("S2", "c", "t"), ("S3", "d", "u"))
    p = frame(spark, "shelf_id string, item_category string, item_subcategory string, threshold_pct double, min_qty int, active boolean, updated_at date",
              (None, "c", None, 11.0, 1, True, "1998-01-01"), (None, "c", "s", 12.0, 2, True, "1998-01-01"), (None, None, None, 13.0, 3, True, "1998-01-01"))
    got = A.resolve_policy(shelves, p, by_category=True)
    assert rows(got, "shelf_id", "threshold_pct", "min_qty") == [("S1", 12.0, 2), ("S2", 11.0, 1), ("S3", 13.0, 3)]


def test_state_null_quantities_and_unknown_events(spark):
    opening = frame(spark, STATE, ("S1", 5, 1.0, "1998-01-01 00:00:00"), ("S2", 5, 1.0, "1998-01-01 00:00:00"), ("S3", 5, 1.0, "1998-01-01 00:00:00"))
    e = frame(spark, EVENTS, ("S1", "pickup", None, "1998-07-01 00:00:00"), ("S2", "weight_change", None, "1998-05-01 00:00:00"), ("S4", "putback", 2, "1998-07-01 00:00:00"))
    profiles = frame(spark, "shelf_id string, item_weight double", ("S4", 0.5))
    got = inv.shelf_state(e, opening, profiles, ts())
    assert rows(got) == [
        ("S1", 5, 1.0, "1998-01-01 00:00:00"),  # only null quantities: not touched
        ("S2", 5, 1.0, "1998-06-01 12:00:00"),  # no change, but touched
        ("S3", 5, 1.0, "1998-01-01 00:00:00"),
        ("S4", 2, 0.5, "1998-07-01 00:00:00"),  # new shelf: event time counts
    ]


def test_state_in_two_steps(spark):
    opening = frame(spark, STATE, ("S1", 5, 1.0, "1998-01-01 00:00:00"))
    profiles = frame(spark, "shelf_id string, item_weight double", ("S1", 2.0))
    a = frame(spark, EVENTS, ("S1", "pickup", 3, "1998-06-02 00:00:00"), ("S2", "putback", 1, "1998-06-02 00:00:00"))
    b = frame(spark, EVENTS, ("S1", "putback", 1, "1998-06-03 00:00:00"), ("S2", "pickup", 4, "1998-06-01 00:00:00"))
    once = inv.shelf_state(a.union(b), opening, profiles, ts())
    twice = inv.shelf_state(b, inv.shelf_state(a, opening, profiles, ts()), profiles, ts())
    assert rows(once) == rows(twice)


def test_plans_keep_their_id_and_issued_plans_stay(spark):
    levels = frame(spark, "shelf_id string, current_stock int, min_qty int, threshold_pct double, stock_pct double, suggested_qty int",
                   ("S1", 0, 1, 30.0, 0.0, 8), ("S2", 0, 1, 30.0, 0.0, 8))
    one, two = A.restock_plans(levels, ts()), A.restock_plans(levels, ts())
    assert rows(one) == rows(two)
    table = frame(spark, "plan_id string, shelf_id string, suggested_qty int, status string, created_at timestamp, updated_at timestamp",
                  ("old1", "S1", 3, "issued", "1998-05-01 00:00:00", "1998-05-01 00:00:00"), ("old2", "S2", 3, "pending", "1998-05-01 00:00:00", "1998-05-01 00:00:00"))
    got = A.keep_open_plans(table, one)
    assert rows(got, "shelf_id", "suggested_qty", "status") == [("S1", 3, "issued"), ("S2", 8, "pending")]


def test_young_plans_wait_and_arrivals_need_their_delay(spark):
    p = frame(spark, "plan_id string, status string, created_at timestamp", ("a", "pending", "1998-06-01 11:59:00"), ("b", "pending", "1998-06-01 11:59:01"), ("c", "issued", "1998-01-01 00:00:00"))
    assert rows(P.mature_plans(p, ts(), 60), "plan_id") == [("a",)]
    out = frame(spark, "event_type string, event_id string, shelf_id string, batch_code string, qty int, ts timestamp",
                ("wh_out", "1", "S1", "B", 2, "1998-06-01 11:57:00"), ("wh_out", "2", "S1", "B", 3, "1998-06-01 11:57:01"), ("wh_in", "3", "S1", "B", 3, "1998-06-01 01:00:00"), ("wh_out", "4", "S1", "B", 0, "1998-06-01 01:00:00"))
    emitted, pending = P.refill_rows(out, frame(spark, "shelf_id string, item_weight double", ("S1", 0.5)), ts(), 3)
    assert rows(emitted, "event_id", "event_type", "quantity", "delta_weight") == [("1", "putback", 2, None), ("1", "weight_change", None, 1.0)]
    assert rows(pending, "event_id", "available_at") == [("2", "1998-06-01 12:00:01")]


def test_sales_match_lot_and_item(spark):
    lots = frame(spark, LOTS, ("S1", "B", "1998-01-01", "1998-09-01", 5, "1998-01-01 00:00:00"), ("S2", "B", "1998-01-01", "1998-09-01", 5, "1998-01-01 00:00:00"))
    lines = frame(spark, "item_id string, batch_code string, quantity int, ts timestamp", ("S1", "B", 7, "1998-02-01 00:00:00"), ("S9", "X", 1, "1998-02-01 00:00:00"))
    assert rows(inv.lots_after_sales(lines, lots), "shelf_id", "batch_quantity_store") == [("S1", -2), ("S2", 5)]
    assert rows(inv.lots_after_sales(lines, lots, match_item=False), "shelf_id", "batch_quantity_store") == [("S1", -2), ("S2", -2)]


def test_one_lot_with_two_date_spellings(spark):
    wh = frame(spark, "shelf_id string, batch_code string, received_date date, expiry_date date, batch_quantity_warehouse int, batch_quantity_store int, last_update_ts timestamp",
               ("S1", "B", "1998-01-01", "1998-09-01", 5, 0, "1998-01-01 00:00:00"))
    store = frame(spark, LOTS, ("S9", "Z", "1998-01-01", "1998-09-01", 1, "1998-01-01 00:00:00"))
    e = frame(spark, "event_type string, shelf_id string, batch_code string, qty int, ts timestamp, received_date date, expiry_date date",
              ("wh_in", "S1", "B", 4, "1998-02-01 00:00:00", "1998-01-02", None), ("wh_out", "S1", "B", 3, "1998-02-02 00:00:00", None, None), ("wh_out", "S1", "N", 2, "1998-02-02 00:00:00", None, "1998-10-01"))
    a, b = inv.lots_after_wh_events(e, wh, store)
    assert rows(a, "batch_code", "received_date", "batch_quantity_warehouse", "batch_quantity_store") == [("B", "1998-01-02", 6, 0), ("N", None, -2, 0)]
    assert rows(b, "batch_code", "batch_quantity_store", "expiry_date") == [("B", 3, None), ("N", 2, "1998-10-01"), ("Z", 1, "1998-09-01")]


def test_removal_floors_at_zero_and_alerts_once_per_shelf(spark):
    shelf = frame(spark, STATE, ("S1", 5, 1.0, "1998-01-01 00:00:00"))
    lots = frame(spark, LOTS, ("S1", "A", "1998-01-01", "1998-05-01", 4, "1998-01-01 00:00:00"), ("S1", "B", "1998-01-01", "1998-05-31", 4, "1998-01-01 00:00:00"), ("S1", "C", "1998-01-01", "1998-06-01", 4, "1998-01-01 00:00:00"))
    s, l, a = inv.remove_expired(shelf, lots, day(), ts())
    assert rows(s, "current_stock") == [(0,)] and rows(l, "batch_code", "batch_quantity_store") == [("A", 0), ("B", 0), ("C", 4)]
    assert rows(a, "shelf_id", "suggested_qty") == [("S1", 8)]
    assert inv.remove_expired(shelf, lots, day(), ts(), alert_per_lot=True)[2].count() == 2
    assert rows(inv.remove_expired(shelf, lots, day(), ts(), "same_day_evening")[2], "suggested_qty") == [(12,)]
    with pytest.raises(ValueError):
        inv.expired(lots, day(), "never")


def test_expired_and_empty_lots_do_not_hide_near_expiry(spark):
    lots = frame(spark, LOTS, ("S1", "A", "1998-01-01", "1998-05-01", 4, "1998-01-01 00:00:00"), ("S1", "B", "1998-01-01", "1998-06-02", 0, "1998-01-01 00:00:00"), ("S1", "C", "1998-01-01", "1998-06-04", 2, "1998-01-01 00:00:00"))
    shelves = frame(spark, "shelf_id string", ("S1",))
    found = A.near_expiry(A.soonest_expiry(lots, "batch_quantity_store", day()), shelves, day(), 5)
    assert rows(found, "min_expiry", "days_to_expiry", "qty_on_batches") == [("1998-06-04", 3, 2)]
    assert A.near_expiry(A.soonest_expiry(lots, "batch_quantity_store", day(), all_lots=True), shelves, day(), 5).count() == 0


def test_daily_discount_can_run_twice(spark):
    lots = frame(spark, LOTS, ("S1", "A", "1998-01-01", "1998-06-01", 4, "1998-01-01 00:00:00"), ("S2", "B", "1998-01-01", "1998-06-02", 4, "1998-01-01 00:00:00"))
    base = frame(spark, "shelf_id string, discount_date date, discount double, source string", ("S1", "1998-06-01", 0.2, "promo"))
    fresh, table, alerts = D.daily_discount(lots, base, day(), ts())
    again = D.daily_discount(lots, table, day(), ts())[0]
    assert rows(fresh, "shelf_id", "discount_date") == [("S1", "1998-06-01"), ("S2", "1998-06-01"), ("S2", "1998-06-02")]
    assert rows(again) == rows(fresh) and alerts.count() == 2
    assert all(0 <= r["discount"] < 1 for r in fresh.collect())


def test_rolling_sums_start_when_full(spark):
    raw = frame(spark, "shelf_id string, feature_date date, sales_qty int", *[("S1", f"1998-01-{d:02}", d) for d in range(1, 11)])
    got = {str(r["feature_date"])[-2:]: (r["sales_last_1d"], r["sales_last_7d"]) for r in FX.sales_lags(raw).collect()}
    assert got["01"] == (0, 0) and got["07"] == (6, 0) and got["08"] == (7, 28) and got["09"] == (8, 35)


def test_alert_history_spans(spark):
    raw = frame(spark, "shelf_id string, feature_date date, f int", *[("S1", f"1998-{m:02}-{d:02}", 1) for m in (1, 2) for d in range(1, 29)])
    last = lambda df: {str(r["feature_date"]): r["n"] for r in df.collect()}["1998-02-28"]
    assert last(FX.alert_history(raw, "f", "n")) == 29
    assert last(FX.alert_history(raw, "f", "n", by_rows=False)) == 27


def test_folds_follow_time(spark):
    df = frame(spark, "shelf_id string, feature_date date", *[(s, f"1998-01-{d:02}") for s in ("S1", "S2") for d in range(1, 13)])
    blocks = ml.cv_folds(df).groupBy("feature_date").agg(F.countDistinct("block").alias("n"), F.max("block").alias("b")).orderBy("feature_date").collect()
    assert [r["b"] for r in blocks] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5] and {r["n"] for r in blocks} == {1}
    assert ml.cv_folds(df.where("feature_date < '1998-01-03'")).agg(F.max("block")).first()[0] == 0


def test_rounding_of_reorder_points(spark):
    df = frame(spark, "a int, b int", (10, None), (30, None), (None, 50), (5, None))
    assert [r[0] for r in df.select(S.reorder_point("a", "b")).collect()] == [1, 2, 3, 1]


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(3, 1.005, 0.0), (2, 10.0, 0.235)], "q int, p double, d double")
    assert [r[0] for r in df.select(M.line_total("q", "p", "d")).collect()] == [3.03, 15.2]


def test_supplier_order_adds_new_plans_once(spark):
    plans = frame(spark, "supplier_plan_id string, shelf_id string, suggested_qty int, standard_batch_size int, status string, created_at timestamp, updated_at timestamp",
                  ("a", "S1", 4, 2, "pending", "1998-05-01 00:00:00", "1998-05-01 00:00:00"), ("b", "S1", 3, None, " Pending", "1998-05-01 00:00:00", "1998-05-01 00:00:00"))
    empty = frame(spark, "order_id string, delivery_date date, shelf_id string, total_qty int, status string, cutoff_ts timestamp, delivery_ts timestamp, created_at timestamp, updated_at timestamp",
                  ("x", "1990-01-01", "S0", 0, "delivered", None, None, None, None)).limit(0)
    orders, after = P.supplier_cutoff(plans, empty, ts())
    assert rows(orders, "delivery_date", "shelf_id", "total_qty") == [("1998-06-03", "S1", 7)]  # Monday noon: Wednesday
    again, _ = P.supplier_cutoff(after, orders, ts())
    assert rows(again) == rows(orders)
    more, _ = P.supplier_cutoff(plans.limit(1), orders, ts())
    assert rows(more, "total_qty") == [(11,)]
    wed = ts("1998-06-03 09:00:00")
    receipts = frame(spark, "receipt_id string, delivery_date date, shelf_id string, received_qty int, created_at timestamp", ("r", "1990-01-01", "S0", 1, None)).limit(0)
    events, got, delivered, done = P.supplier_delivery(orders, receipts, after, wed)
    assert rows(events, "batch_code", "qty", "expiry_date") == [("SUP-19980603-S1-1", 7, "1999-06-03")]
    assert rows(done, "status") == [("completed",), ("completed",)] and rows(delivered, "status") == [("delivered",)]
    assert P.supplier_delivery(orders, got, after, wed)[0].count() == 0


def test_ids_equal_the_standard(spark):
    names = ["a", "wh_in:1998-06-01:S1", "é中", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", ids.uuid5("n"), ids.uuid5_mod("n")).collect()
    for n, u, m in got:
        want = uuid.uuid5(uuid.NAMESPACE_URL, n)
        assert (u, m) == (str(want), want.int % 1_000_000)


def test_stochastic_round(spark):
    df = spark.createDataFrame([(None, "k"), (-1.0, "k"), (0.0, "k"), (float("nan"), "k"), (float("inf"), "k"), (3.0, "k"), (2.5, "k")], "x double, k string")
    draw = uuid.uuid5(uuid.NAMESPACE_URL, "k").int % 1_000_000 / 1_000_000
    assert [r[0] for r in df.select(ids.stochastic_round("x", "k")).collect()] == [0, 0, 0, 0, 0, 3, 3 if draw < 0.5 else 2]


def test_status_changes_in_order(spark):
    alerts = frame(spark, "alert_id string, event_type string, shelf_id string, location string, status string, updated_at timestamp",
                   ("1", "refill", "S1", "store", "open", None), ("2", "expiry", "S1", "store", "ack", None), ("3", "refill", "S1", "store", "dismissed", None), ("4", "refill", "S2", "store", "dismissed", None))
    changes = frame(spark, "alert_id string, shelf_id string, location string, alert_event_type string, status string, seq int",
                    (None, "S1", "store", "refill", "closed", 2), (None, "S1", "store", None, "ack", 1), (None, "S1", "store", None, "ignored", 3), ("4", None, None, None, "NEW", 1), ("4", None, None, None, "odd word", 2), (None, "S1", None, None, "done", 9))
    got = merge.apply_status(alerts, changes, ts())
    assert rows(got, "alert_id", "status") == [("1", "resolved"), ("2", "dismissed"), ("3", "dismissed"), ("4", "ack")]
    assert rows(got.where("updated_at is null"), "alert_id") == [("3",)]


def test_status_by_place_after_status_by_id(spark):
    alerts = frame(spark, "alert_id string, event_type string, shelf_id string, location string, status string, updated_at timestamp",
                   *[(str(k), "refill", "S1", "store", "open", None) for k in range(5)])
    changes = [("0", "ack", 1), (None, "resolved", 2), ("1", "ack", 3), ("2", "closed", 4), (None, "ack", 5), (None, "ignored", 6), ("3", "new", 7), (None, "ack", 8)]
    df = frame(spark, "alert_id string, shelf_id string, location string, alert_event_type string, status string, seq int",
               *[(i, "S1", "store", None if q % 4 else "refill", s, q) for i, s, q in changes])
    want = [("0", "resolved"), ("1", "dismissed"), ("2", "resolved"), ("3", "ack"), ("4", "resolved")]
    assert rows(merge.apply_status(alerts, df, ts()), "alert_id", "status") == want
    for cut in (1, 3, 4, 6):  # the same in two batches
        first = merge.apply_status(alerts, df.where(f"seq <= {cut}"), ts())
        assert rows(merge.apply_status(first, df.where(f"seq > {cut}"), ts()), "alert_id", "status") == want


def test_transfer_keeps_all_goods(spark):
    lots = frame(spark, "g string, batch_code string, expiry_date date, qty int", ("a", "x", None, 10), ("a", "y", "1998-01-01", 4), ("b", "z", None, 3))
    after, moved = P.transfer(lots, frame(spark, "g string, need int", ("a", 8), ("b", 9)), "g", "qty", "need")
    assert rows(after, "g", "batch_code", "qty") in ([("a", "x", 6)], [("a", "x", 2), ("a", "y", 4)])
    assert sum(r["qty"] for r in after.union(moved.select(*after.columns)).collect()) == 17


def test_upsert_twice_is_upsert_once(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    s = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    put = lambda x: merge.upsert(x, s, ["k"], {"v": F.col("s.v")}, {"v": F.col("s.v")})
    assert rows(put(t)) == rows(put(put(t))) == [("a", 1), ("b", 5), ("c", 6)]
    assert rows(merge.upsert(t, s, ["k"], {"v": F.col("s.v")})) == [("a", 1), ("b", 5)]


def test_insert_if_absent_with_null_key(spark):
    t = spark.createDataFrame([(None, 1)], "k string, v int")
    s = spark.createDataFrame([(None, 2), ("a", 2)], "k string, v int")
    assert rows(merge.insert_if_absent(t, s, ["k"], null_safe=True)) == [("a", 2)]
    assert merge.insert_if_absent(t, s, ["k"]).count() == 2


def test_latest_row_orders_nulls_last(spark):
    df = frame(spark, "k string, t timestamp, v int", ("a", None, 9), ("a", "1998-01-01 00:00:00", 1), ("a", "1998-01-01 00:00:00", 2), ("b", None, 3), (None, None, 4))
    assert rows(latest.latest_per_key(df, ["k"], ["t"]), "k", "v") == [("a", 2), ("b", 3), (None, 4)]


def test_backfill_only_when_mostly_missing(spark):
    m = spark.createDataFrame([("a", 7), ("b", 8)], "k string, v int")
    half = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    few = spark.createDataFrame([("a", None), ("b", 1), ("b", 2)], "k string, v int")
    assert rows(align.backfill(half, m, "k", "v")) == [("a", 7), ("b", 1)]
    assert rows(align.backfill(few, m, "k", "v")) == [("a", None), ("b", 1), ("b", 2)]


def test_week_spans(spark):
    w = frame(spark, "shelf_id string, week_start date, week_end date, discount_pct double",
              ("S1", "1998-05-04", "1998-05-10", 20.0), ("S1", "1998-05-10", "1998-05-17", 0.3), ("S2", "1998-05-04", "1998-05-01", 0.1))
    got = rows(D.weekly_to_daily(w))
    assert len(got) == 13 and ("S1", "1998-05-10", 0.3) in got and ("S1", "1998-05-16", 0.3) in got and ("S1", "1998-05-04", 0.2) in got


def test_order_dates_use_the_first_filled_column(spark):
    ddl = "status string, delivery_ts timestamp, cutoff_ts timestamp, delivery_date date"
    a = frame(spark, ddl, ("issued", "1998-05-01 00:00:00", "1999-01-01 00:00:00", "1999-01-01"), ("Cancelled", "1999-05-01 00:00:00", None, None))
    assert rows(R.order_dates(a, ts())) == [(None, "1998-05-01 00:00:00", "delivery_ts")]
    b = frame(spark, ddl, ("issued", None, None, "1998-06-01"), ("issued", None, None, "1998-05-01"))
    assert rows(R.order_dates(b, ts())) == [("1998-06-01 00:00:00", "1998-06-01 00:00:00", "delivery_date")]


def test_restock_day_falls_back_to_received_date(spark):
    e = frame(spark, "event_type string, shelf_id string, qty int, ts timestamp, received_date date",
              ("wh_in", "S1", 2, None, "1998-05-01"), ("wh_in", "S2", 3, None, "1998-05-02"), ("wh_out", "S2", 9, "1998-07-01 00:00:00", None))
    assert rows(R.restock_day(e), "restock_day", "items", "shelves") == [("1998-05-02", 3, 1)]


def test_delivery_calendar(spark):
    df = frame(spark, "t timestamp", ("1998-06-01 07:59:00",), ("1998-06-01 08:00:00",), ("1998-06-05 09:00:00",), ("1998-06-07 00:00:00",))
    assert [str(r[0]) for r in df.select(T.next_delivery("t")).collect()] == ["1998-06-01", "1998-06-03", "1998-06-08", "1998-06-08"]


def test_status_words(spark):
    df = spark.createDataFrame([(s,) for s in (" Active ", "DONE", "ignored", "x", "", None)], "s string")
    assert [r[0] for r in df.select(X.alert_status("s")).collect()] == ["open", "resolved", "dismissed", "ack", "ack", "ack"]


def test_demand_smoothing_equals_the_loop(spark):
    xs = [3, 0, 7, 1, 9]
    df = frame(spark, "k string, d date, x int", *[("a", f"1998-01-0{i + 1}", x) for i, x in enumerate(xs)])
    e = 2.0
    for x in xs:
        e = 0.9 * e + 0.1 * x
    assert FX.ewma(df, "k", "d", "x", F.lit(2.0)).first()["demand_ewma"] == pytest.approx(e)


def test_model_registry(spark):
    cols = "model_name string, model_version string, trained_at timestamp, metrics_json string, artifact_path string"
    reg = frame(spark, cols, (ml.MODEL, "v1", "1998-05-01 00:00:00", "{}", "/m/gone"))
    paths = spark.createDataFrame([(f"/m/{ml.MODEL}_19980101_000000.json",), (f"/m/{ml.MODEL}_19980301_000000",), ("/m/other_19990101_000000.json",)], "path string")
    assert rows(ml.usable_model(reg, paths), "model_version") == [("19980301_000000",)]
    there = paths.union(spark.createDataFrame([("/m/gone",)], "path string"))
    assert rows(ml.usable_model(reg, there), "model_version") == [("v1",)]
    assert ml.retrain_due(reg, ts(), 31).first()["due"] and not ml.retrain_due(reg, ts(), 32).first()["due"]
    assert ml.retrain_due(reg, ts(), 0).first()["due"] and ml.retrain_due(reg.limit(0), ts(), 99).first()["due"]
    new = frame(spark, cols, (ml.MODEL, "v2", "1998-06-01 00:00:00", "{}", "/m/v2"))
    assert rows(ml.register(reg, new), "model_version") == [("v2",)]
    assert rows(ml.register(reg, new, keep_existing=True), "model_version") == [("v1",)]


def test_demand_by_category(spark):
    df = spark.createDataFrame([("BEERS",), ("FISH",), ("other",), (None,)], "c string")
    assert [r[0] for r in df.select(S.category_demand("c")).collect()] == [1.05, 0.6, 0.6, 0.6]


def test_capacity_in_batches(spark):
    df = spark.createDataFrame([(25, 6), (5, 6), (24, 6)], "b int, s int")
    assert [tuple(r) for r in df.select(S.capacity_in_batches("b", "s", True), S.capacity_in_batches("b", "s", False)).collect()] == [(30, 24), (12, 12), (24, 24)]


def test_epoch_unit_is_recognised(spark):
    df = spark.createDataFrame([(896702400,), (896702400000,)], "n bigint")
    assert {str(r[0]) for r in df.select(T.from_epoch("n")).collect()} == {"1998-06-01 12:00:00"}


def test_stock_rule_for_orders(spark):
    df = spark.createDataFrame([(5, 20, 100, 0, 6), (95, 120, 100, 0, 6), (50, 40, 100, 1, 6), (50, 40, 100, 0, 6), (None, 20, 0, 0, None)],
                               "stock int, point int, cap int, alert int, size int")
    assert [r[0] for r in df.select(S.fallback_batches("stock", "point", "cap", "alert", "size")).collect()] == [3, 0, 1, 0, 20]


@pytest.mark.parametrize("errors,patience,want", [
    ([5, 4, 3, 3, 3, 3], 3, (3, True)), ([5, 4, 3, 3, 3], 3, (3, False)), ([1, 2, 3, 0], 2, (1, True)), ([1, 2, 3, 0], 3, (4, False)),
    ([1, 2, 0, 4], 3, (3, False)), ([1], 1, (1, False)),
])
def test_best_round(errors, patience, want):
    """An equal error is no fall; an error after the stop does not count."""
    assert ml.best_round(errors, patience) == want


def test_training_keeps_the_best_round(spark):
    cols = "shelf_id string, feature_date date, item_category string, item_subcategory string, x int, z int, batches_to_order int"
    data = [(f"s{k % 20}", f"1998-01-{1 + k // 20:02}", "AB"[k % 2], f"c{k % 3}", k % 7, k * 31 % 11, k % 7 // 2 + k % 2) for k in range(240)]
    got = ml.train(frame(spark, cols, *data), k=2, max_iter=12, max_depth=3, patience=2)
    assert [(f.fold, f.train_rows, f.val_rows) for f in got.folds] == [(1, 80, 80), (2, 160, 80)]
    assert all(1 <= f.rounds <= f.grown <= 12 and f.mae < f.mae_of_mean for f in got.folds)
    best = next(f for f in got.folds if f.fold == got.fold)
    assert got.mae == best.mae == min(f.mae for f in got.folds) and got.model.stages[-1].getNumTrees == best.rounds
    # A category that was not there in training is scored all the same.
    assert got.model.transform(frame(spark, cols, ("s", "1998-02-01", "new", "new", 1, 1, 0))).first()["prediction"] is not None
    assert ml.train(frame(spark, cols, *data[:40]), max_iter=1) is None
