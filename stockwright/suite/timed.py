"""Streams over several micro-batches: input arrives in slices, and the stream is stopped and started again between them."""
from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_per_key
from ..plans.alerts import restock_plans, shelf_levels, supplier_plans, wh_levels
from ..streaming import jobs as J, timed as T
from ..streaming.runner import append_stream, run_stream
from ..workspace import new_folder
from .alerting import uuid_sql
from .fixtures import Inputs, now_ts, oracle
from .pricing import ORACLES as PRICING
from .state import LEVELS, POLICY_LATEST, REFILL

ORDER = ["seq1", "seq2", "seq3", "seq4"]
DAYS = ("1996-06-01", "1997-09-01", "1998-06-01")  # where the slices of the event tables are cut
WAVES = 3


def by_day(df: DataFrame, ts_col: str) -> list[DataFrame]:
    """All rows in slices of time."""
    number = sum((F.col(ts_col) >= F.lit(d).cast("timestamp")).cast("int") for d in DAYS)
    return [df.where(number == k) for k in range(len(DAYS) + 1)]


def arriving(i: Inputs, label: str, slices: dict[str, list[DataFrame]], start: Callable[..., StreamingQuery]) -> str:
    """Writes slice after slice, each followed by a run of the stream from its checkpoint; gives the folder of its output."""
    root = new_folder(i.spark, label)
    for arrived in zip(*slices.values()):
        for name, rows in zip(slices, arrived):
            rows.write.mode("append").parquet(f"{root}/in/{name}")
        sources = {n: i.spark.readStream.schema(s[0].schema).parquet(f"{root}/in/{n}") for n, s in slices.items()}
        start(root, **sources).awaitTermination()
    return root


def q_checkouts(i: Inputs):
    """Shoppers and their visits arrive together in four batches; visits still open at the end of a batch are closed in a later one."""
    start = lambda root, events, visits: append_stream(T.checkout_stream(events, visits, now_ts(), ORDER), f"{root}/out", f"{root}/progress")
    root = arriving(i, "checkouts", {"events": by_day(i["shelf_events"], "ts"), "visits": by_day(i["shop_visits"], "entry_time")}, start)
    return i.spark.read.parquet(f"{root}/out").select("visit_id", "checkout_ts", "customer_id", "item_id", "quantity")


def q_refill(i: Inputs):
    """Every exit is delivered twice: in its own batch, and once more in the same or in the next one, when it may have been sent already."""
    once = by_day(i["wh_exits"], "ts")
    again = [rows.where("qty % 2 = 1") for rows in once]
    late = [once[0].limit(0), *[rows.where("qty % 2 = 0") for rows in once[:-1]]]
    late[-1] = late[-1].unionByName(once[-1].where("qty % 2 = 0"))
    slices = [a.unionByName(b).unionByName(c) for a, b, c in zip(once, again, late)]
    start = lambda root, exits: append_stream(T.refill_stream(exits, i.profiles, remember_days=3650), f"{root}/out", f"{root}/progress")
    root = arriving(i, "refill", {"exits": slices}, start)
    return i.spark.read.parquet(f"{root}/out").select("event_id", "event_type", "shelf_id", "quantity", F.round("delta_weight", 6).alias("delta_weight"), "ts")


def q_cooldown(i: Inputs):
    """Alerts are raised, raised again half an hour later, and a third time before or after the hour is over."""
    waves = i["alert_waves"]
    start = lambda root, alerts: append_stream(T.cooled_alerts(alerts), f"{root}/out", f"{root}/progress")
    root = arriving(i, "cooled", {"alerts": [waves.where(F.col("wave") == k).drop("wave") for k in range(WAVES)]}, start)
    return i.spark.read.parquet(f"{root}/out").select("event_type", "shelf_id", "location", "created_at")


def planned(i: Inputs, label: str, waves: DataFrame, existing: DataFrame, plans_of) -> DataFrame:
    start = lambda root, levels: run_stream(J.newest_levels(levels), J.open_plans_job(root, plans_of), f"{root}/progress", "update")
    root = arriving(i, label, {"levels": [waves.where(F.col("wave") == k).drop("wave") for k in range(WAVES)]}, start)
    return J.open_plans(existing, i.spark.read.parquet(f"{root}/plans"))


def q_shelf_plans(i: Inputs):
    """The same shelves report their stock three times; each keeps one pending plan, and issued plans stay."""
    plans_of = lambda rows, now: restock_plans(shelf_levels(rows, i["shelf_policies"], i["inventory"]), now)
    existing = i["restock_plans"].withColumn("updated_at", F.col("created_at"))
    return planned(i, "shelf-plans", i["shelf_waves"], existing, plans_of).select("plan_id", "shelf_id", "suggested_qty", "status", "created_at")


def q_wh_plans(i: Inputs):
    plans_of = lambda rows, now: supplier_plans(wh_levels(rows, i["wh_policies"]), i["inventory"].select("shelf_id", "standard_batch_size"), now)
    waves = i["shelf_waves"].withColumn("wh_current_stock", F.expr("current_stock div 4")).drop("current_stock")
    return planned(i, "wh-plans", waves, i["supplier_plans"], plans_of).select("supplier_plan_id", "shelf_id", "suggested_qty", "standard_batch_size", "status", "created_at")


def q_limited(i: Inputs):
    """Newest level per shelf, read one file at a time: as many micro-batches as files, however the files are named."""
    root = new_folder(i.spark, "limited")
    i["shelf_waves"].repartition(5).write.parquet(f"{root}/in")
    source = i.spark.readStream.schema(i["shelf_waves"].schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = run_stream(J.newest_levels(source.drop("wave")), J.changelog_sink(f"{root}/log", "levels"), f"{root}/progress", "update")
    query.awaitTermination()
    log = i.spark.read.parquet(f"{root}/log")
    batches = log.agg(F.count_distinct("batch_id")).scalar()
    return latest_per_key(log, ["shelf_id"], ["batch_id"], []).select("shelf_id", "current_stock", "last_update_ts", batches.alias("batches"))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "stream_checkouts": q_checkouts,
    "stream_refill_redelivered": q_refill,
    "stream_cooled_alerts": q_cooldown,
    "stream_shelf_plans": q_shelf_plans,
    "stream_wh_plans": q_wh_plans,
    "stream_rate_limited": q_limited,
}

_due = """SELECT e.*, i.item_weight FROM wh_exits e LEFT JOIN inventory i ON e.shelf_id = i.shelf_id
  WHERE qty > 0 AND ts + INTERVAL '3' MINUTE <= (SELECT MAX(ts) FROM wh_exits)"""
_levels = LEVELS.replace("FROM state s JOIN", "FROM shelf_waves s JOIN").replace("FROM state s LEFT JOIN", "FROM shelf_waves s LEFT JOIN").replace(
    "SELECT s.shelf_id, s.current_stock,", "SELECT s.shelf_id, s.wave, s.last_update_ts, s.current_stock,").replace(
    "SELECT s.shelf_id, COALESCE", "SELECT s.shelf_id, s.wave, COALESCE").replace("ON s.shelf_id = p.shelf_id", "ON s.shelf_id = p.shelf_id AND s.wave = p.wave")


def _merged(fresh: str, existing: str, columns: str) -> str:
    """Existing plans but pending ones of shelves with a fresh plan, and the last fresh plan of shelves without an issued one."""
    return f"""SELECT {columns} FROM {existing} e WHERE NOT (e.status = 'pending' AND EXISTS (SELECT 1 FROM last_plan f WHERE f.shelf_id = e.shelf_id))
      UNION ALL SELECT {columns} FROM last_plan"""


_last = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shelf_id ORDER BY wave DESC) AS rn FROM fresh) WHERE rn = 1
  AND shelf_id NOT IN (SELECT shelf_id FROM {existing} WHERE status = 'issued')"""
_stamp = "strftime(last_update_ts, '%Y-%m-%d %H:%M:%S')"

ORACLES = {
    "stream_checkouts": PRICING["checkouts"],
    "stream_refill_redelivered": oracle(
        """SELECT event_id, 'putback' AS event_type, shelf_id, qty AS quantity, CAST(NULL AS DOUBLE) AS delta_weight, ts FROM due
           UNION ALL SELECT event_id, 'weight_change', shelf_id, NULL, ROUND(item_weight * qty, 6), ts FROM due""", "wh_exits", "inventory", due=_due),
    "stream_cooled_alerts": oracle(
        """SELECT DISTINCT event_type, shelf_id, location, created_at FROM alert_waves a WHERE NOT EXISTS
           (SELECT 1 FROM alert_waves b WHERE b.wave = 0 AND a.wave > 0 AND b.event_type = a.event_type AND b.shelf_id = a.shelf_id AND b.location = a.location
            AND a.created_at - b.created_at <= INTERVAL '60' MINUTE)""", "alert_waves"),
    "stream_shelf_plans": oracle(
        _merged("fresh", "restock_plans", "plan_id, shelf_id, suggested_qty, status, created_at"), "shelf_waves", "inventory", "shelf_policies", "restock_plans",
        policy=POLICY_LATEST, levels=_levels, refill=REFILL,
        fresh=f"""SELECT {uuid_sql(f"'restock:' || {_stamp} || ':' || shelf_id")} AS plan_id, shelf_id, CAST(suggested_qty AS INT) AS suggested_qty,
                  'pending' AS status, last_update_ts AS created_at, wave FROM refill WHERE suggested_qty > 0""",
        last_plan=_last.format(existing="restock_plans")),
    "stream_wh_plans": oracle(
        _merged("fresh", "supplier_plans", "supplier_plan_id, shelf_id, suggested_qty, standard_batch_size, status, created_at"), "shelf_waves", "inventory", "wh_policies", "supplier_plans",
        fresh=f"""SELECT {uuid_sql(f"'supplier:' || {_stamp} || ':' || shelf_id")} AS supplier_plan_id, shelf_id, CAST(CEIL(gap / (bs * 1.0)) * bs AS INT) AS suggested_qty,
                  bs AS standard_batch_size, 'pending' AS status, last_update_ts AS created_at, wave FROM
                  (SELECT s.shelf_id, s.wave, s.last_update_ts, i.standard_batch_size AS bs, COALESCE(p.reorder_point_qty, 10) - s.current_stock // 4 AS gap
                   FROM shelf_waves s JOIN inventory i ON s.shelf_id = i.shelf_id LEFT JOIN (SELECT * FROM wh_policies WHERE active) p ON s.shelf_id = p.shelf_id) WHERE gap > 0""",
        last_plan=_last.format(existing="supplier_plans")),
    "stream_rate_limited": oracle(
        "SELECT shelf_id, current_stock, last_update_ts, CAST(5 AS BIGINT) AS batches FROM shelf_waves WHERE wave = 2", "shelf_waves"),
}
