"""Queries over written tables: loads with checks, later columns, repeated writes, pruned scans, the model registry."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import ml, reports as R
from ..schemas import columns
from ..sources.files import in_partitions, read_checked, read_csv, read_evolved
from ..sources.messages import encode, with_shelf
from ..sources.sinks import append_batch, create_if_absent, export, retry, write_if_empty, write_partitioned
from ..workspace import new_folder
from .fixtures import NOW, Inputs, now_ts, oracle
from .modelling import ML_PARTS, planned
from .state import TS

SUPPLIED = "S7"  # the shelf whose years of supply are looked up
ON_DISK_UNTIL = "1996-01-01"


def q_pruned(i: Inputs):
    """Sales in the years in which one shelf was supplied, from a table partitioned by year."""
    root = new_folder(i.spark, "sales-by-year")
    sales = i["receipt_lines"].select("transaction_id", "item_id", "quantity", F.date_format("ts", "yyyy").alias("year"))
    write_partitioned(sales, root, "year")
    written = i.spark.read.schema("transaction_id bigint, item_id string, quantity int, year string").parquet(root)
    supplied = i["wh_lots"].where(F.col("shelf_id") == SUPPLIED).select(F.date_format("received_date", "yyyy").alias("year"))
    return in_partitions(written, supplied, "year").groupBy("year", "item_id").agg(F.count("*").alias("n"), F.sum("quantity").alias("units"))


def q_checked(i: Inputs):
    """An exported inventory with damaged numbers and lost keys: good and bad rows."""
    root = new_folder(i.spark, "inventory-csv")
    stock = F.col("current_stock")
    export(i["inventory"].select(
        F.when(stock % 7 != 0, F.col("shelf_id")).alias("shelf_id"), "item_category",
        F.when(stock % 11 == 0, "many").otherwise(stock.cast("string")).alias("current_stock")), root, "csv")
    good, bad = read_checked(i.spark, root, columns("shelf_id string, item_category string, current_stock int"), ["shelf_id"])
    return good.unionByName(bad, allowMissingColumns=True)


def q_export(i: Inputs):
    """Lots exported as text and read back with their types."""
    root = new_folder(i.spark, "lots-csv")
    lots = i["wh_lots"].select("shelf_id", "batch_code", "received_date", "expiry_date", "qty")
    export(lots, root, "csv")
    return read_csv(i.spark, root, columns("shelf_id string, batch_code string, received_date date, expiry_date date, qty int"), ["shelf_id", "batch_code"])


def q_later(i: Inputs):
    """A table made empty, filled, and filled again after it got two more columns."""
    root = new_folder(i.spark, "stock-later")
    rows, old = i["inventory"], F.col("item_category") == "PROMO"
    first = columns("shelf_id string, current_stock int")
    create_if_absent(i.spark, root, first)
    rows.where(old).select(*first.names).write.mode("append").parquet(root)
    create_if_absent(i.spark, root, first)  # leaves it as it is
    now = columns("shelf_id string, current_stock int, item_category string, standard_batch_size int")
    rows.where(~old).select(*now.names).write.mode("append").parquet(root)
    return read_evolved(i.spark, root, now, {"item_category": "unknown"})


def q_first_fill(i: Inputs):
    """The first fill of a table is kept, a second one is not made."""
    root = new_folder(i.spark, "first-fill")
    rows = i["inventory"].select("shelf_id", "current_stock")
    made = [write_if_empty(rows.limit(0), root), write_if_empty(rows, root), write_if_empty(rows.withColumn("current_stock", F.lit(-1)), root)]
    return i.spark.read.schema(rows.schema).parquet(root).withColumn("fills", F.lit(sum(made)))


def q_replayed(i: Inputs):
    """Three batches of which one fails after its write and is tried again, and one is sent twice."""
    root, lost = new_folder(i.spark, "replayed"), [True]

    def write(batch: int) -> None:
        append_batch(i["shelf_waves"].where(F.col("wave") == batch).drop("wave"), root, batch)
        if batch == 1 and lost:
            lost.pop()
            raise OSError("lost after the write")

    for batch in (0, 1, 2, 2):
        retry(lambda b=batch: write(b), sleep=lambda s: None)
    rows = i.spark.read.parquet(root)
    return rows.select("shelf_id", "current_stock", "last_update_ts", F.col("batch_id").cast("bigint").alias("batch_id"))


def q_fallback(i: Inputs):
    """Events of producers that send only the item."""
    e = i["shelf_events"].withColumns({"shelf_id": F.when(F.col("event_type") != "putback", F.col("shelf_id")), "item_id": F.concat(F.lit("I"), "item_id")})
    return with_shelf(e).groupBy("shelf_id", "event_type").agg(F.count("*").alias("n"), F.sum("quantity").alias("units"))


def q_top_predictions(i: Inputs):
    return R.topk(planned(i)[1], [F.desc("feature_date"), F.desc("created_at"), "shelf_id"], 50)


def q_top_plans(i: Inputs):
    plans = i["supplier_plans"].select("supplier_plan_id", "shelf_id", "suggested_qty", "status", F.col("created_at").alias("updated_at"))
    return R.topk(plans, [F.desc("updated_at"), "supplier_plan_id"], 50)


def registry(i: Inputs):
    """A model trained with every order: those of finished orders have the name in use."""
    trained = F.expr("CAST(o_orderdate AS TIMESTAMP) + make_interval(0, 0, 0, 0, 0, 0, CAST(o_orderkey % 86400 AS INT))")
    rows = i.table("orders").select(F.when(F.col("o_orderstatus") == "F", ml.MODEL).otherwise("other").alias("model_name"), trained.alias("trained_at"),
                                    F.concat(F.lit('{"mae": '), F.col("o_orderkey").cast("string"), F.lit("}")).alias("metrics_json"))
    version = ml.model_version("trained_at")
    return rows.select("model_name", version.alias("model_version"), "trained_at", "metrics_json", F.concat(F.lit("models/"), "model_name", F.lit("_"), version).alias("artifact_path"))


def q_usable(i: Inputs):
    """The files of the registered model are gone: the newest model that is still on disk."""
    known = registry(i)
    return ml.usable_model(known, known.where(F.col("trained_at") < F.lit(ON_DISK_UNTIL).cast("timestamp")).select(F.col("artifact_path").alias("path")))


def q_registered(i: Inputs):
    """One row per model name: that of a new model replaces the registered one, other names stay."""
    known = registry(i)
    last = known.groupBy("model_name").agg(F.max_by(F.struct(*known.columns[1:]), F.struct("trained_at", "metrics_json")).alias("r")).select("model_name", "r.*")
    fresh = last.where(F.col("model_name") == ml.MODEL).withColumn("metrics_json", F.lit("{}"))
    return ml.register(last, fresh)


def q_due(i: Inputs):
    """Whether to train again, for several age limits."""
    due = [ml.retrain_due(registry(i), now_ts(), days).select(F.lit(days).alias("days"), "due") for days in (0, 30, 100_000)]
    none = ml.retrain_due(registry(i), now_ts(), 30, "unheard").select(F.lit(-1).alias("days"), "due")
    return due[0].union(due[1]).union(due[2]).union(none)


QUERIES = {
    "pruned_scan": q_pruned,
    "checked_load": q_checked,
    "export_csv": q_export,
    "later_columns": q_later,
    "first_fill": q_first_fill,
    "replayed_batches": q_replayed,
    "message_null_key": lambda i: encode(i["wh_lots"].select("shelf_id", "batch_code", "qty")),
    "shelf_fallback": q_fallback,
    "top_predictions": q_top_predictions,
    "top_supplier_plans": q_top_plans,
    "latest_model": lambda i: ml.latest_model(registry(i)),
    "usable_model": q_usable,
    "model_registry": q_registered,
    "retrain_due": q_due,
}

_registry = f"""SELECT model_name, strftime(trained_at, '%Y%m%d_%H%M%S') AS model_version, trained_at, metrics_json,
  'models/' || model_name || '_' || strftime(trained_at, '%Y%m%d_%H%M%S') AS artifact_path FROM
  (SELECT CASE WHEN o_orderstatus = 'F' THEN '{ml.MODEL}' ELSE 'other' END AS model_name,
   CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * CAST(o_orderkey % 86400 AS INT) AS trained_at, '{{"mae": ' || o_orderkey || '}}' AS metrics_json FROM orders)"""
_log = """SELECT '{m}' AS model_name, feature_date, shelf_id, CAST(batches AS INT) AS predicted_batches, CAST(batches * standard_batch_size AS INT) AS suggested_qty,
  '{v}' AS model_version, {t} AS created_at FROM batches ORDER BY feature_date DESC, created_at DESC, shelf_id LIMIT 50""".format(m=ml.MODEL, v="19980601_120000", t=TS)
_text = "CASE WHEN current_stock % 11 = 0 THEN 'many' ELSE CAST(current_stock AS VARCHAR) END"
_due = f"(SELECT MAX(trained_at) FROM registry WHERE model_name = '{ml.MODEL}')"

ORACLES = {
    "pruned_scan": oracle(
        f"""SELECT strftime(ts, '%Y') AS year, item_id, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS units FROM receipt_lines
            WHERE strftime(ts, '%Y') IN (SELECT strftime(received_date, '%Y') FROM wh_lots WHERE shelf_id = '{SUPPLIED}') GROUP BY 1, 2""", "receipt_lines", "wh_lots"),
    "checked_load": oracle(
        f"""SELECT k AS shelf_id, item_category, CASE WHEN current_stock % 11 <> 0 THEN CAST(current_stock AS INT) END AS current_stock, reason,
            CASE WHEN reason IS NOT NULL THEN COALESCE(k, '') || ',' || item_category || ',' || {_text} END AS line FROM
            (SELECT *, CASE WHEN current_stock % 7 <> 0 THEN shelf_id END AS k,
             CASE WHEN current_stock % 11 = 0 THEN 'unreadable' WHEN current_stock % 7 = 0 THEN 'missing' END AS reason FROM inventory)""", "inventory"),
    "export_csv": oracle("SELECT shelf_id, batch_code, received_date, expiry_date, qty FROM wh_lots", "wh_lots"),
    "later_columns": oracle(
        """SELECT shelf_id, current_stock, CASE WHEN item_category = 'PROMO' THEN 'unknown' ELSE item_category END AS item_category,
           CASE WHEN item_category <> 'PROMO' THEN standard_batch_size END AS standard_batch_size FROM inventory""", "inventory"),
    "first_fill": oracle("SELECT shelf_id, current_stock, 2 AS fills FROM inventory", "inventory"),
    "replayed_batches": oracle("SELECT shelf_id, current_stock, last_update_ts, CAST(wave AS BIGINT) AS batch_id FROM shelf_waves", "shelf_waves"),
    "message_null_key": oracle(
        """SELECT CAST(NULL AS VARCHAR) AS key, '{"shelf_id":"' || shelf_id || '","batch_code":"' || batch_code || '","qty":' || qty || '}' AS value FROM wh_lots""", "wh_lots"),
    "shelf_fallback": oracle(
        """SELECT CASE WHEN event_type = 'putback' THEN 'I' || item_id ELSE shelf_id END AS shelf_id, event_type, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS units
           FROM shelf_events GROUP BY 1, 2""", "shelf_events"),
    "top_predictions": oracle(_log, "feature_rows", **ML_PARTS),
    "top_supplier_plans": oracle(
        """SELECT supplier_plan_id, shelf_id, suggested_qty, status, created_at AS updated_at FROM supplier_plans
           ORDER BY updated_at DESC, supplier_plan_id LIMIT 50""", "supplier_plans"),
    "latest_model": oracle(f"SELECT * FROM registry WHERE model_name = '{ml.MODEL}' ORDER BY trained_at DESC, model_version DESC LIMIT 1", registry=_registry),
    "usable_model": oracle(
        f"""SELECT model_name, model_version, trained_at, CAST(NULL AS VARCHAR) AS metrics_json, artifact_path FROM registry
            WHERE model_name = '{ml.MODEL}' AND trained_at < TIMESTAMP '{ON_DISK_UNTIL}' ORDER BY model_version DESC LIMIT 1""", registry=_registry),
    "model_registry": oracle(
        f"""SELECT model_name, model_version, trained_at, CASE WHEN model_name = '{ml.MODEL}' THEN '{{}}' ELSE metrics_json END AS metrics_json, artifact_path FROM
            (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY trained_at DESC, metrics_json DESC) AS rn FROM registry) WHERE rn = 1""", registry=_registry),
    "retrain_due": oracle(
        f"""SELECT 0 AS days, TRUE AS due UNION ALL SELECT 30, {_due} <= TIMESTAMP '{NOW}' - INTERVAL '30' DAY
            UNION ALL SELECT 100000, {_due} <= TIMESTAMP '{NOW}' - INTERVAL '100000' DAY UNION ALL SELECT -1, TRUE""", registry=_registry),
}
