"""Ordered scans and allocation: the sliced plan against the plain one, and invariants on random rows."""
import random
from collections import defaultdict

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from stockwright.operators.allocate import allocate, apportion, shortage, split_batches
from stockwright.operators.ordered import ordered_scan
from stockwright.plans import planning, sales


def skewed(spark, n=600, seed=3):
    """A third of the rows on one key; values with gaps."""
    r = random.Random(seed)
    data = [("hot" if k % 3 == 0 else f"k{r.randrange(40)}", k, r.randrange(10), r.choice([None, None, f"v{k}"])) for k in range(n)]
    r.shuffle(data)
    return data, spark.createDataFrame(data, "k string, o int, v int, x string")


def by_hand(data):
    groups = defaultdict(list)
    for k, o, v, x in data:
        groups[k].append((o, v, x))
    out = {}
    for k, items in groups.items():
        items.sort()
        total, last = 0, None
        for n, (o, v, x) in enumerate(items):
            last = x if x is not None else last
            ahead = next((y for _, _, y in items[n:] if y is not None), None)
            out[o] = (total, last, ahead)
            total += v
    return out


def test_scan(spark):
    data, df = skewed(spark)
    got = ordered_scan(df.repartition(5), ["k"], ["o"], sums={"s": "v"}, carry_on={"l": "x"}, look_ahead={"a": "x"})
    assert {r["o"]: (r["s"], r["l"], r["a"]) for r in got.collect()} == by_hand(data)


def test_a_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None if k % 3 else "a", k, 1) for k in range(300)], "k string, o int, v int").repartition(5)
    got = {r["o"]: r["s"] for r in ordered_scan(df, ["k"], ["o"], sums={"s": "v"}).collect()}
    assert [got[k] for k in range(300) if k % 3] == list(range(200))


def test_order_is_by_name(spark):
    with pytest.raises(ValueError):
        ordered_scan(spark.range(3), ["id"], [F.col("id")], sums={"s": "id"})


def test_slices_spread_a_large_key(spark):
    _, df = skewed(spark, 3000)
    one = df.withColumn("k", F.lit("only"))
    parts = one.repartitionByRange(4, "k", "o").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 1500


def demand_supply(spark, seed=1, n=300):
    r = random.Random(seed)
    groups = lambda: "hot" if r.random() < 0.4 else f"g{r.randrange(8)}"
    demand = [(groups(), f"d{k:04}", r.randrange(0, 30)) for k in range(n)]
    supply = [(groups(), f"s{k:04}", r.randrange(0, 25)) for k in range(n)]
    return demand, supply, spark.createDataFrame(demand, "g string, d string, need int"), spark.createDataFrame(supply, "g string, s string, qty int")


def fill(demand, supply):
    """Reference by loops."""
    out, missing = [], {}
    left = defaultdict(list)
    for g, s, q in sorted(supply, key=lambda x: x[1]):
        left[g].append([s, q])
    for g, d, need in sorted(demand, key=lambda x: x[1]):
        for lot in left[g]:
            take = min(need, lot[1])
            if take > 0:
                out.append((g, d, lot[0], take))
                lot[1] -= take
                need -= take
        if need:
            missing[d] = need
    return sorted(out), missing


@pytest.mark.parametrize("seed", [1, 2])
def test_allocation(spark, seed):
    demand, supply, dd, sd = demand_supply(spark, seed)
    got = allocate(dd, sd, "g", ["d"], ["s"], "need", "qty", unserved=True).collect()
    want, missing = fill(demand, supply)
    assert sorted((r["g"], r["d"], r["s"], r["take"]) for r in got if r["s"] is not None) == want
    assert {r["d"]: r["take"] for r in got if r["s"] is None} == missing


def test_allocation_invariants(spark):
    demand, supply, dd, sd = demand_supply(spark, 9)
    got = allocate(dd, sd, "g", ["d"], ["s"], "need", "qty")
    per_lot = {r["s"]: r["t"] for r in got.groupBy("s").agg(F.sum("take").alias("t")).collect()}
    assert all(per_lot.get(s, 0) <= q for _, s, q in supply)
    short = {r["d"]: r for r in shortage(dd, got, ["d"], "need").collect()}
    assert all(short[d]["served"] + short[d]["missing"] == need for _, d, need in demand)
    for g in {x[0] for x in demand}:
        need, have = sum(n for k, _, n in demand if k == g), sum(q for k, _, q in supply if k == g)
        assert sum(short[d]["served"] for k, d, _ in demand if k == g) == min(need, have)


def test_each_demand_alone(spark):
    demand, supply, dd, sd = demand_supply(spark, 4, 80)
    got = allocate(dd, sd, "g", ["d"], ["s"], "need", "qty", per_demand=True).collect()
    want = []
    for one in demand:
        want += fill([one], supply)[0]
    assert sorted((r["g"], r["d"], r["s"], r["take"]) for r in got) == sorted(want)


def test_column_clash(spark):
    df = spark.createDataFrame([("a", "x", 1)], "g string, id string, q int")
    with pytest.raises(ValueError):
        allocate(df, df, "g", ["id"], ["id"], "q", "q")


def test_plans_share_lots_in_order(spark):
    """Two plans on one shelf must not take the same lot twice; per_plan lets them."""
    plans = frame(spark, "shelf_id string, plan_id string, suggested_qty int, created_at timestamp",
                  ("S1", "P2", 6, "1998-06-01 10:00:00"), ("S1", "P1", 5, "1998-06-01 11:00:00"))
    lots = frame(spark, "shelf_id string, batch_code string, received_date date, expiry_date date, batch_quantity_warehouse int",
                 ("S1", "B1", "1998-01-02", "1998-09-01", 4), ("S1", "B2", "1998-01-01", "1998-08-01", 4), ("S1", "B3", "1998-01-01", "1998-08-01", 0))
    shared = planning.fifo_allocation(plans, lots)
    assert rows(shared, "plan_id", "batch_code", "alloc_qty") == [("P1", "B1", 2), ("P2", "B1", 2), ("P2", "B2", 4)]
    alone = planning.fifo_allocation(plans, lots, per_plan=True)
    assert rows(alone, "plan_id", "batch_code", "alloc_qty") == [("P1", "B1", 1), ("P1", "B2", 4), ("P2", "B1", 2), ("P2", "B2", 4)]


def test_transfer_conserves_goods(spark):
    src = frame(spark, "g string, batch_code string, expiry_date date, qty int", ("a", "x", "1998-07-01", 5), ("a", "y", "1998-06-20", 3), ("b", "z", "1998-06-20", 2))
    want = spark.createDataFrame([("a", 4)], "g string, need int")
    after, moved = planning.transfer(src, want, "g", "qty", "need")
    assert rows(after, "g", "batch_code", "qty") == [("a", "x", 4), ("b", "z", 2)]
    assert rows(moved, "batch_code", "expiry_date", "qty") == [("x-T", "1998-07-01", 1), ("y-T", "1998-06-20", 3)]


def test_split(spark):
    df = spark.createDataFrame([("a", 10, 4), ("b", 0, 4), ("c", 8, 4), ("d", 3, 0)], "k string, q int, b int")
    assert rows(split_batches(df, "q", "b"), "k", "batch_no", "batch_qty") == [("a", 1, 4), ("a", 2, 4), ("a", 3, 2), ("c", 1, 4), ("c", 2, 4)]


@pytest.mark.parametrize("total,weights,want", [
    (10, [1, 1, 1], [4, 3, 3]), (7, [0, 0, 0], [3, 2, 2]), (5, [6, 3, 1], [3, 2, 0]), (0, [1, 2, 3], [0, 0, 0]), (-2, [1, 1, 1], [0, 0, 0]),
])
def test_apportion(spark, total, weights, want):
    df = spark.createDataFrame([("d", i, w, total) for i, w in enumerate(weights)], "d string, slot int, w int, total int")
    got = [r["share"] for r in apportion(df, ["d"], "total", "w", "slot").orderBy("slot").collect()]
    assert got == want and sum(got) == max(0, total)


def test_cart_floors_at_each_step(spark):
    r = random.Random(5)
    data = [("c1" if k % 3 == 0 else f"c{r.randrange(9)}", f"i{r.randrange(3)}", r.choice(["pickup", "putback", "weight_change"]), r.randrange(1, 6), k) for k in range(300)]
    held = defaultdict(int)
    for c, i, e, q, _ in data:
        if e == "pickup":
            held[c, i] += q
        elif e == "putback":
            held[c, i] = max(0, held[c, i] - q)
    df = spark.createDataFrame(data, "customer_id string, item_id string, event_type string, quantity int, seq int").repartition(6)
    got = {(x["customer_id"], x["item_id"]): x["quantity"] for x in sales.cart_state(df, ["seq"]).collect()}
    assert got == {k: v for k, v in held.items()}


def test_checkouts_take_the_latest_visit(spark):
    visits = frame(spark, "visit_id string, customer_id string, entry_time timestamp, exit_time timestamp",
                   ("v1", "c", "1998-06-01 08:00:00", "1998-06-01 08:30:00"), ("v2", "c", "1998-06-01 09:00:00", None), ("v3", "d", "1998-06-01 08:00:00", None))
    events = frame(spark, "customer_id string, item_id string, event_type string, quantity int, ts timestamp, seq int",
                   ("c", "x", "pickup", 2, "1998-06-01 08:10:00", 1), ("c", "x", "putback", 5, "1998-06-01 08:11:00", 2), ("c", "x", "pickup", 1, "1998-06-01 08:12:00", 3),
                   ("c", "y", "pickup", 9, "1998-06-01 08:40:00", 4), ("c", "z", "pickup", 3, "1998-06-01 09:10:00", 5), ("d", "q", "pickup", 4, "1998-06-01 08:05:00", 6))
    from helpers import ts
    got = sales.checkouts(events, visits, ts(), ["seq"])
    # v1 left; v3 is older than three hours at noon; v2 (09:00) is exactly three hours old and still in.
    assert rows(got, "visit_id", "item_id", "quantity") == [("v1", "x", 1), ("v3", "q", 4)]


def test_long_receipts_are_split(spark):
    lines = frame(spark, "cart_id string, item_id string, batch_code string, quantity int, unit_price double, discount double, total_price double, expiry_date date",
                  *[("a", f"i{k}", None if k % 2 else f"b{k}", 1, 1.0, 0.0, 1.0, None) for k in range(5)], ("b", "x", None, 2, 1.0, 0.0, 2.0, "1998-07-01"))
    carts = frame(spark, "cart_id string, customer_id string, checkout_ts timestamp", ("a", "c1", "1998-06-01 12:00:00"), ("b", "c2", "1998-06-01 12:00:00"))
    got = sorted((r["customer_id"], r["part"], [i["item_id"] for i in r["items"]]) for r in sales.receipts(lines, carts, 2).collect())
    assert got == [("c1", 0, ["i0", "i1"]), ("c1", 1, ["i2", "i3"]), ("c1", 2, ["i4"]), ("c2", 0, ["x"])]


def test_receipts_are_whole(spark):
    lines = spark.range(1200).selectExpr("'a' AS cart_id", "concat('i', id) AS item_id", "CAST(NULL AS string) AS batch_code", "1 AS quantity", "1.0D AS unit_price",
                                         "0.0D AS discount", "1.0D AS total_price", "CAST(NULL AS date) AS expiry_date")
    carts = frame(spark, "cart_id string, customer_id string, checkout_ts timestamp", ("a", "c1", "1998-06-01 12:00:00"))
    one = sales.receipts(lines, carts).collect()
    assert len(one) == 1 and len(one[0]["items"]) == 1200
    flat = sorted(r["line_no"] for r in sales.receipt_rows(lines, carts).collect())
    assert flat == list(range(1, 1201))
    parts = sales.receipts(lines, carts, 500).collect()
    assert sorted(len(r["items"]) for r in parts) == [200, 500, 500] and len({r["message_id"] for r in parts}) == 3
    assert {r["transaction_id"] for r in parts} == {one[0]["transaction_id"]} and one[0]["message_id"] in {r["message_id"] for r in parts}
