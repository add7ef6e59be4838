"""Readers, writers, messages and routing."""
import pytest
from helpers import frame, rows, ts
from pyspark.sql import functions as F

from stockwright import schemas
from stockwright.operators import align
from stockwright.plans import config, routing
from stockwright.sources import files, jdbc, messages, sinks


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "store_inventory.csv").write_text("item_price,shelf_id,current_stock,extra\n1.5, S1 ,7,x\nbad,S2,8,y\n")
    got = files.read_csv(spark, str(tmp_path / "store_inventory.csv"), schemas.STORE_INVENTORY, ["shelf_id"])
    assert rows(got, "shelf_id", "item_price", "current_stock") == [("S1", 1.5, 7), ("S2", None, 8)]
    with pytest.raises(ValueError, match="missing columns"):
        files.read_csv(spark, str(tmp_path / "store_inventory.csv"), schemas.STORE_INVENTORY, ["aisle"])


def test_reference_load(spark, tmp_path):
    for n in ("store_inventory", "warehouse_inventory"):
        (tmp_path / f"{n}.csv").write_text("shelf_id,maximum_stock\nS1,7\n")
    for n in ("store_batches", "warehouse_batches"):
        (tmp_path / f"{n}.csv").write_text("shelf_id,batch_code,expiry_date\nS1,B1,1998-07-01\n")
    ref = config.load_reference(spark, str(tmp_path), ts())
    assert rows(ref["store_batches"], "batch_code", "expiry_date", "snapshot_ts") == [("B1", "1998-07-01", "1998-06-01 12:00:00")]
    (tmp_path / "panel.csv").write_text("shelf_id,feature_date,is_weekend\nS1,1998-06-01,true\n")
    assert rows(config.load_panel(spark, str(tmp_path / "panel.csv")), "is_weekend") == [(True,)]


def test_scan_pushes_filters_and_columns(spark):
    df = files.read_table(spark, "/root/testdata/sf0.001/part.parquet", ["p_partkey", "p_size"], [F.col("p_size") > 40])
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,40)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
    with pytest.raises(ValueError):
        files.read_table(spark, "/root/testdata/sf0.001/part.parquet", ["nothing"])


def test_tables_are_created_once(spark, tmp_path):
    names = sinks.create_tables(spark, str(tmp_path))
    assert len(names) == 16
    frame(spark, "shelf_id string, total_stock int, last_update_ts timestamp", ("S1", 1, None)).write.mode("append").parquet(f"{tmp_path}/curated/product_total_state")
    sinks.create_tables(spark, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/curated/product_total_state").count() == 1
    assert spark.read.parquet(f"{tmp_path}/curated/features_store").schema.names == schemas.DAILY_FEATURES.names


def test_retry_waits_longer_each_time():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "done"

    assert sinks.retry(flaky, sleep=waits.append) == "done" and waits == [0.8, 1.6]
    with pytest.raises(OSError):
        sinks.retry(lambda: (_ for _ in ()).throw(OSError("no")), retryable=lambda e: False, sleep=waits.append)
    with pytest.raises(OSError):
        sinks.retry(lambda: (_ for _ in ()).throw(OSError("no")), attempts=2, sleep=waits.append)


def test_messages_round_trip(spark):
    rows_in = frame(spark, "shelf_id string, current_stock int, item_weight double, last_update_ts timestamp", ("S1", 3, 1.5, "1998-06-01 12:00:00"))
    wire = messages.encode(rows_in, ["shelf_id"])
    assert rows(wire, "key") == [("S1",)]
    assert rows(messages.decode(wire, schemas.SHELF_STATE)) == rows(rows_in)
    bad = spark.createDataFrame([("not json",), ('{"shelf_id": "S2", "current_stock": "x"}',), (None,)], "value string")
    assert rows(messages.decode(bad, schemas.SHELF_STATE, not_null=["shelf_id"]), "shelf_id", "current_stock") == [("S2", None)]
    null_key = messages.encode(rows_in)
    assert rows(null_key, "key") == [(None,)]


def test_receipt_message(spark):
    text = '{"event_type":"pos_transaction","transaction_id":"t","customer_id":"c","timestamp":"1998-06-01T14:00:00+02:00","items":[{"item_id":"S1","quantity":2}]}'
    got = messages.decode(spark.createDataFrame([(text,)], "value string"), schemas.POS_TRANSACTIONS)
    r = got.first()
    assert str(r["timestamp"]) == "1998-06-01 12:00:00" and r["items"][0]["quantity"] == 2


def test_old_events_name_the_item_only(spark):
    df = spark.createDataFrame([(None, "S1"), ("S2", "x")], "shelf_id string, item_id string")
    assert rows(messages.with_shelf(df), "shelf_id") == [("S1",), ("S2",)]


def test_incremental_mark(spark):
    df = frame(spark, "k string, updated_at timestamp", ("a", "1998-06-01 12:00:00"), ("b", "1998-06-01 12:00:01"))
    got, mark = files.incremental(df, "updated_at", ts())
    assert rows(got, "k") == [("b",)] and rows(mark) == [("1998-06-01 12:00:01",)]
    _, same = files.incremental(df, "updated_at", ts("1999-01-01 00:00:00"))
    assert rows(same) == [("1999-01-01 00:00:00",)]
    assert files.topic_name("config.shelf_policies") == "shelf_policies" and files.topic_name("x.y") == "x.y"
    assert rows(files.keyed_rows(df.select("k"), ["k"]), "key") == [("a",), ("b",)]


def test_deleted_keys_leave_the_snapshot(spark):
    log = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, True), ("b", 3, False)], "k string, o int, _deleted boolean")
    assert rows(files.changelog_snapshot(log, ["k"], ["o"]), "k") == [("b",)]


def test_stream_mapping():
    assert routing.parse_mapping(" a=x , b = y,") == {"a": "x", "b": "y"}
    for bad in ("", "a", "a=", "=x"):
        with pytest.raises(ValueError):
            routing.parse_mapping(bad)


def test_database_queries():
    assert jdbc.select_query("t", ["a", "b"], "a > 1") == "SELECT a, b FROM t WHERE a > 1"
    db = jdbc.Database("jdbc:postgresql://h/d", "u", "p", options={"stringtype": "unspecified"})
    assert db.settings()["stringtype"] == "unspecified" and db.settings()["driver"].startswith("org.postgresql")


def test_unreadable_database_is_no_source(spark):
    db = jdbc.Database("jdbc:none:x", "u", "p", driver="no.such.Driver")
    assert jdbc.read_optional(spark, db, "t", ["a"]) is None


def test_first_usable_source(spark):
    empty, full = spark.createDataFrame([], "a int"), spark.createDataFrame([(1,)], "a int")
    seen = []
    pick = lambda n, df: lambda: (seen.append(n), df)[1]
    assert align.first_usable(pick(1, empty), pick(2, full), pick(3, full)).count() == 1 and seen == [1, 2]
    assert align.first_usable(lambda: empty).count() == 0


def test_align_prefers_the_present_name(spark):
    df = spark.createDataFrame([("7", None, 9.6)], "a string, b string, old double")
    target = schemas.columns("a int, new bigint, b int, c date")
    assert rows(align.align_to_schema(df, target, {"new": ("old",)})) == [(7, 9, None, None)]
    assert align.add_missing(df, target).columns == ["a", "b", "old", "new", "c"]


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    sinks.export(df, f"{tmp_path}/c", "csv")
    assert rows(spark.read.option("header", True).csv(f"{tmp_path}/c")) == [("1", "x")]


def test_scan_is_pruned_when_it_runs(spark, tmp_path):
    spark.range(1000).selectExpr("id", "concat('d', id % 10) AS day").write.partitionBy("day").parquet(str(tmp_path / "t"))
    spark.createDataFrame([("d3", 1), ("d4", 2), ("d4", 1)], "day string, kind int").write.parquet(str(tmp_path / "dim"))
    wanted = spark.read.parquet(str(tmp_path / "dim")).where("kind = 1")
    got = files.in_partitions(spark.read.parquet(str(tmp_path / "t")), wanted, "day")
    assert {r["day"] for r in got.collect()} == {"d3", "d4"} and got.count() == 200
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


def test_bad_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,n\nx,1\n,2\ny,many\nz,\nw,3,4\n")
    good, bad = files.read_checked(spark, str(tmp_path), schemas.columns("k string, n int"), ["k"])
    assert rows(good) == [("x", 1), ("z", None)]
    assert sorted(map(str, rows(bad, "reason", "line"))) == sorted(map(str, [("missing", ",2"), ("unreadable", "y,many"), ("unreadable", "w,3,4")]))


def test_defaults_of_later_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1)], "k string, gone int").write.parquet(path)
    spark.createDataFrame([("b", 2), ("c", None)], "k string, n int").write.mode("append").parquet(path)
    schema = schemas.columns("k string, n int, later date")
    assert rows(files.read_evolved(spark, path, schema, {"n": 7})) == [("a", 7, None), ("b", 2, None), ("c", 7, None)]
    assert files.read_evolved(spark, path, schema).schema.names == ["k", "n", "later"]
