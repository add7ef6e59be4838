"""A stream over any split of the input ends where the batch job ends, also after a restart."""
import itertools

import pytest
from helpers import frame, rows, ts
from pyspark.sql import functions as F

from stockwright.operators.align import align_to_schema
from stockwright.plans import inventory as inv, sales
from stockwright.schemas import SHELF_STATE
from stockwright.sources.files import stream_files
from stockwright.sources.sinks import append_batch, read_version, save_bucketed, write_if_empty, write_partitioned
from stockwright.streaming import jobs as J
from stockwright.streaming.runner import append_stream, changelog_table, each_day, read_keyed, run_stream
from stockwright.workspace import cut, new_folder, shared_dir

EVENTS = "shelf_id string, item_id string, customer_id string, event_type string, quantity int, ts timestamp, seq int"


def shelf_events(spark, n=60):
    kinds = itertools.cycle(["pickup", "putback", "pickup", "weight_change"])
    data = [(f"S{k % 5 if k % 3 else 0}", f"S{k % 4}", f"C{k % 3}", e, 1 + k * 7 % 5, f"1998-06-01 {8 + k // 12:02}:{k % 60:02}:00", k)
            for k, e in zip(range(n), kinds)]
    return frame(spark, EVENTS, *data)


def split(df, folder, n):
    """The rows as n files that arrive in the order of seq."""
    total = df.count()
    for k in range(n):
        part = df.where((F.col("seq") >= k * total // n) & (F.col("seq") < (k + 1) * total // n)).coalesce(1)
        part.write.mode("append").parquet(folder)


def opening(spark):
    return align_to_schema(frame(spark, "shelf_id string, current_stock int, item_weight double, last_update_ts timestamp",
                                 ("S0", 50, 1.0, "1998-01-01 00:00:00"), ("S9", 4, 1.0, "1998-01-01 00:00:00")), SHELF_STATE)


PROFILES = "shelf_id string, item_weight double"


@pytest.mark.parametrize("n", [1, 3, 10])
def test_shelf_state(spark, tmp_path, n):
    events = shelf_events(spark)
    split(events, f"{tmp_path}/in", n)
    profiles = frame(spark, PROFILES, ("S0", 2.0), ("S1", 3.0))
    want = rows(inv.shelf_state(events, opening(spark), profiles, ts()))
    source = lambda: stream_files(spark, f"{tmp_path}/in", events.schema, max_files=1)
    job = J.shelf_state_job(f"{tmp_path}/state", f"{tmp_path}/log", opening(spark), profiles, ts(), compact_every=4)
    run_stream(source(), job, f"{tmp_path}/ck").awaitTermination()
    assert rows(read_keyed(spark, f"{tmp_path}/state", SHELF_STATE, ["shelf_id"])) == want
    # The published rows end at the same state for every shelf that was touched.
    log = changelog_table(spark.read.parquet(f"{tmp_path}/log"), ["shelf_id"])
    assert rows(log.select(*SHELF_STATE.names)) == [r for r in want if r[0] != "S9"]
    # Update mode gives the same net changes.
    J.shelf_delta_stream(source(), f"{tmp_path}/deltas", f"{tmp_path}/ck2").awaitTermination()
    deltas = changelog_table(spark.read.parquet(f"{tmp_path}/deltas"), ["shelf_id"])
    assert rows(deltas, "shelf_id", "delta") == rows(inv.shelf_deltas(events), "shelf_id", "delta")


def test_repeated_batch_changes_nothing(spark, tmp_path):
    events, profiles = shelf_events(spark), frame(spark, PROFILES, ("S0", 2.0))
    job = J.shelf_state_job(f"{tmp_path}/state", f"{tmp_path}/log", opening(spark), profiles, ts())
    job = J.shelf_state_job(f"{tmp_path}/state", f"{tmp_path}/log", opening(spark), profiles, ts(), compact_every=2)
    part = lambda a, b: events.where(f"seq >= {a} and seq < {b}")
    # Batch 1 and batch 3 also compact the state; both are run twice.
    for batch_id, part in ((0, part(0, 10)), (1, part(10, 30)), (1, part(10, 30)), (2, part(30, 40)), (3, part(40, 60)), (3, part(40, 60))):
        job(part, batch_id)
    assert rows(read_keyed(spark, f"{tmp_path}/state", SHELF_STATE, ["shelf_id"])) == rows(inv.shelf_state(events, opening(spark), profiles, ts()))


@pytest.mark.parametrize("n", [1, 4])
def test_cart(spark, tmp_path, n):
    events = shelf_events(spark)
    split(events, f"{tmp_path}/in", n)
    job = J.cart_job(f"{tmp_path}/state", f"{tmp_path}/out", ["ts", "seq"])
    run_stream(stream_files(spark, f"{tmp_path}/in", events.schema, max_files=1), job, f"{tmp_path}/ck").awaitTermination()
    got = read_keyed(spark, f"{tmp_path}/state", J.CART_STATE, J.CART_KEY)
    assert rows(got, "customer_id", "item_id", "quantity") == rows(sales.cart_state(events, ["ts", "seq"]))


def test_cart_checkout_empties_the_cart(spark, tmp_path):
    events = shelf_events(spark)
    visits = frame(spark, "customer_id string, entry_time timestamp, exit_time timestamp",
                   ("C0", "1998-06-01 08:00:00", "1998-06-01 09:00:00"), ("C1", "1998-06-01 08:00:00", None), ("C2", "1998-06-01 12:30:00", None))
    job = J.cart_job(f"{tmp_path}/state", f"{tmp_path}/out", ["ts", "seq"], visits)
    open_carts = lambda: read_keyed(spark, f"{tmp_path}/state", J.CART_STATE, J.CART_KEY).where("quantity > 0").select("customer_id").distinct()
    job(events.where("seq < 8"), 0)  # all customers are inside
    assert open_carts().count() == 3
    job(events.where("seq >= 8"), 1)  # C0 has left; C1 entered more than three hours ago
    out = spark.read.parquet(f"{tmp_path}/out").where("batch_id = 1")
    assert set(r[0] for r in rows(out, "customer_id")) == {"C0", "C1"}
    assert rows(open_carts()) == [("C2",)]


WH = "event_id string, event_type string, shelf_id string, batch_code string, qty int, ts timestamp, seq int"


@pytest.mark.parametrize("n", [1, 2, 6])
def test_delayed_refill(spark, tmp_path, n):
    events = frame(spark, WH, *[(str(k), "wh_out" if k % 4 else "wh_in", f"S{k % 2}", "B", 1 + k, f"1998-06-01 12:{2 * k:02}:00", k) for k in range(12)])
    split(events, f"{tmp_path}/in", n)
    profiles = frame(spark, PROFILES, ("S0", 0.5))
    job = J.delayed_refill_job(f"{tmp_path}/state", f"{tmp_path}/out", profiles)
    source = lambda: stream_files(spark, f"{tmp_path}/in", events.schema, max_files=1)
    run_stream(source(), job, f"{tmp_path}/ck").awaitTermination()
    done = spark.read.parquet(f"{tmp_path}/out").where("event_type = 'putback'")
    # The last event is at 12:22: what left by 12:19 has arrived.
    want = [(str(k),) for k in range(12) if k % 4 and 2 * k + 3 <= 22]
    assert rows(done, "event_id") == sorted(want)
    waiting = read_version(spark, f"{tmp_path}/state", J.REFILL_STATE).where("event_id is not null")
    assert rows(waiting, "event_id") == [("10",), ("11",)]
    # A restart with one later event releases the rest; a late row goes out at once.
    frame(spark, WH, ("99", "wh_in", "S0", "B", 1, "1998-06-01 13:00:00", 99), ("98", "wh_out", "S0", "B", 1, "1998-06-01 09:00:00", 98)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run_stream(source(), job, f"{tmp_path}/ck").awaitTermination()
    done = spark.read.parquet(f"{tmp_path}/out").where("event_type = 'putback'")
    assert rows(done, "event_id") == sorted(want + [("10",), ("11",), ("98",)])


def test_cooldown_across_batches(spark, tmp_path):
    cols = "event_type string, shelf_id string, location string, created_at timestamp"
    job = J.cooldown_job(f"{tmp_path}/state", f"{tmp_path}/out", 60)
    at = lambda t: frame(spark, cols, ("refill", "S1", "store", f"1998-06-01 {t}:00"))
    for n, t in enumerate(("12:00", "12:30", "13:00", "13:01", "13:59")):
        job(at(t), n)
    assert [r[0][11:16] for r in rows(spark.read.parquet(f"{tmp_path}/out"), "created_at")] == ["12:00", "13:01"]


def test_dedup_over_batches(spark, tmp_path):
    events = frame(spark, "id string, ts timestamp, seq int", *[(f"e{k % 20}", f"1998-06-01 12:{k:02}:00", k) for k in range(60)])
    split(events, f"{tmp_path}/in", 3)
    source = stream_files(spark, f"{tmp_path}/in", events.schema, max_files=1)
    append_stream(J.deduplicated(source, "id", "ts", "2 hours"), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "id") == sorted((f"e{k}",) for k in range(20))


@pytest.mark.parametrize("n", [1, 3])
def test_lots(spark, tmp_path, n):
    lot = "shelf_id string, batch_code string, received_date date, expiry_date date, batch_quantity_store int, last_update_ts timestamp"
    wh = frame(spark, lot.replace("batch_quantity_store int", "batch_quantity_warehouse int, batch_quantity_store int"), ("S0", "B0", "1998-01-01", "1998-09-01", 9, 0, "1998-01-01 00:00:00"))
    store = frame(spark, lot, ("S0", "B0", "1998-01-01", "1998-09-01", 1, "1998-01-01 00:00:00"))
    events = frame(spark, WH + ", received_date date, expiry_date date",
                   *[(str(k), "wh_out" if k % 3 else "wh_in", f"S{k % 2}", f"B{k % 3}", 1 + k, f"1998-06-01 12:{k:02}:00", k, "1998-05-01", None) for k in range(12)])
    split(events, f"{tmp_path}/in", n)
    job = J.lot_events_job(f"{tmp_path}/wh", f"{tmp_path}/store", wh, store)
    run_stream(stream_files(spark, f"{tmp_path}/in", events.schema, max_files=1), job, f"{tmp_path}/ck").awaitTermination()
    a, b = inv.lots_after_wh_events(events, wh, store)
    assert rows(read_keyed(spark, f"{tmp_path}/wh", wh.schema, J.LOT_KEY)) == rows(a)
    assert rows(read_keyed(spark, f"{tmp_path}/store", store.schema, J.LOT_KEY)) == rows(b)


def test_only_exits_are_dealt_for_store_lots(spark, monkeypatch, tmp_path):
    lots = frame(spark, "shelf_id string, batch_code string, received_date date, expiry_date date, batch_quantity_store int, last_update_ts timestamp",
                 ("S0", "B0", "1998-05-01", "1998-07-01", 5, "1998-05-01 00:00:00"))
    events = frame(spark, WH + ", received_date date, expiry_date date", ("1", "wh_in", "S0", "B0", 4, "1998-06-01 12:00:00", 1, "1998-05-02", None),
                   ("2", "wh_out", "S0", "B0", 3, "1998-06-01 12:01:00", 2, None, None), ("3", "wh_in", "S1", "B1", 2, "1998-06-01 12:02:00", 3, None, None))
    real, seen = J.lots_after_wh_events, []

    def recorded(ev, wh, store):
        seen.append(rows(ev, "event_id"))
        return real(ev, wh, store)

    monkeypatch.setattr(J, "lots_after_wh_events", recorded)
    J.lot_events_job(f"{tmp_path}/wh", f"{tmp_path}/store", lots.withColumnRenamed("batch_quantity_store", "batch_quantity_warehouse").withColumn("batch_quantity_store", F.lit(0)), lots)(events, 0)
    assert seen == [[("1",), ("2",), ("3",)], [("2",)]]
    got = read_keyed(spark, f"{tmp_path}/store", lots.schema, J.LOT_KEY)
    assert rows(got, "shelf_id", "batch_code", "batch_quantity_store") == [("S0", "B0", 8)]


def test_append_of_the_same_batch_replaces_it(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    for batch in (0, 1, 1):
        append_batch(df, f"{tmp_path}/t", batch, "x")
    append_batch(df, f"{tmp_path}/t", 1, "y")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6


def test_days_run_once(spark):
    days = frame(spark, "day date", ("1998-06-01",), ("1998-06-02",), ("1998-06-02",), ("1998-06-03",))
    assert [str(d) for d in each_day(lambda d: d, days, frame(spark, "day date", ("1998-06-02",)))] == ["1998-06-01", "1998-06-03"]


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named.rstrip("/") if named else shared_dir(spark))
    assert new_folder(spark, "x").startswith(shared_dir(spark))
    assert cut(spark.range(5)).count() == 5


def test_young_plans_are_served_later(spark, tmp_path):
    plan = "plan_id string, shelf_id string, suggested_qty int, status string, created_at timestamp, updated_at timestamp"
    lots = frame(spark, "shelf_id string, batch_code string, received_date date, expiry_date date, batch_quantity_warehouse int", ("S1", "B1", "1998-01-01", "1998-09-01", 50))
    job = J.restock_job(f"{tmp_path}/state", f"{tmp_path}/out", lambda: lots)
    job(frame(spark, plan, ("P1", "S1", 5, "pending", "1998-06-01 12:00:00", None)), 0)
    job(frame(spark, plan, ("P2", "S1", 7, "pending", "1998-06-01 12:01:00", None)), 1)
    assert rows(spark.read.parquet(f"{tmp_path}/out/wh_out"), "plan_id", "qty") == [("P1", 5)]
    job(frame(spark, plan, ("P3", "S2", 7, "pending", "1998-06-01 12:09:00", None)), 2)
    assert rows(spark.read.parquet(f"{tmp_path}/out/wh_out"), "plan_id", "qty") == [("P1", 5), ("P2", 7)]


def test_alert_table_has_one_writer(spark, tmp_path):
    from stockwright.schemas import ALERT_FEED, ALERTS
    feed = lambda *r: align_to_schema(frame(spark, "event_type string, shelf_id string, location string, alert_event_type string, status string, created_at timestamp", *r), ALERT_FEED).withColumn("seq", F.monotonically_increasing_id())
    job = J.alert_sink_job(f"{tmp_path}/state", spark.createDataFrame([], ALERTS), ts(), compact_every=1)
    new = ("refill_request", "S1", "store", None, None, "1998-06-01 11:00:00")
    job(feed(new, ("near_expiry", "S1", "store", None, None, "1998-06-01 11:00:00")), 0)
    job(feed(new, ("alert_status_change", "S1", "store", "refill_request", "done", None)), 1)
    assert rows(read_keyed(spark, f"{tmp_path}/state", ALERTS, ["alert_id"]), "event_type", "status") == [("near_expiry", "open"), ("refill_request", "resolved")]


def test_first_fill_and_partitions(spark, tmp_path):
    df = frame(spark, "d date, v int", ("1998-06-01", 1), ("1998-06-02", 2))
    assert write_if_empty(df, f"{tmp_path}/a") and not write_if_empty(df, f"{tmp_path}/a")
    write_partitioned(df, f"{tmp_path}/p", "d")
    write_partitioned(df.where("v = 2").withColumn("v", F.lit(9)), f"{tmp_path}/p", "d")
    assert rows(spark.read.parquet(f"{tmp_path}/p"), "v") == [(1,), (9,)]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for t in ("left_state", "right_state"):
            path = f"{tmp_path}/{t}"
            spark.sql(f"DROP TABLE IF EXISTS {t}")
            df = spark.range(100).select(F.concat(F.lit("S"), "id").alias("shelf_id"), F.col("id").alias(t))
            save_bucketed(df, t, ["shelf_id"], 4, path)
        joined = spark.table("left_state").join(spark.table("right_state"), "shelf_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
