"""Queries that check each family of column expressions over whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts as K, money as M, stock as S, text as X, times as T
from .fixtures import Inputs, oracle


def q_time(i: Inputs):
    e = i.sql("SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM events")
    day = F.to_date("ts")
    sec = F.unix_timestamp("ts")
    return e.select(
        "event_id", T.iso_week(day).alias("week"), T.is_weekend(day).alias("weekend"), F.weekday(day).alias("dow"),
        T.falls_on(day, T.INBOUND_DAYS).alias("inbound"), T.day_part("ts").alias("part"), T.shift("ts", mins=-60).alias("hour_ago"),
        T.days_until(F.date_add(day, 9), F.lit("2024-01-10").cast("date")).alias("days_left"),
        T.from_epoch(sec).alias("from_s"), T.from_epoch(sec * 1000).alias("from_ms"), T.epoch_ms_day(sec * 1000).alias("ms_day"),
        T.parse_instant(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("zulu"),
        T.parse_instant(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("offset"),
        T.parse_instant(F.concat(F.lit("bad "), F.col("event_id").cast("string"))).alias("bad"),
        T.model_version("ts").alias("version"), T.version_instant(T.model_version("ts")).alias("version_ts"),
        T.version_in_path(F.concat(F.lit("/models/m_"), T.model_version("ts"), F.lit(".json")), "m").alias("path_version"),
        T.at_gate("ts", T.CUTOFF_DAYS, 12, 0).alias("at_cutoff"), T.in_lead_window("ts").alias("in_window"),
    )


def q_money(i: Inputs):
    p = i.sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem")
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.round(M.compound("l_discount", "l_tax"), 6).alias("compound"),
        F.round(M.checkout_discount("l_discount", F.col("l_tax") * 12), 6).alias("checkout"),
        F.round(M.effective_discount("l_discount", "l_tax", "add"), 6).alias("added"),
        M.effective_discount("l_discount", "l_tax", "max").alias("larger"),
        F.round(M.as_fraction(F.col("l_quantity") / 2), 6).alias("fraction"),
        F.round(M.discount_from_prices(F.col("l_quantity") - 1, F.col("l_quantity") / 2), 6).alias("from_prices"),
        M.line_total("l_quantity", F.lit(1.005), "l_discount").alias("total"),
    )


def q_text(i: Inputs):
    a = i["alert_history"]
    return a.select(
        "alert_id", X.alert_status("status").alias("normal"), X.is_active("status").alias("active"), X.in_store("location").alias("store"),
        X.in_warehouse("location").alias("warehouse"), X.clean_upper("location").alias("place"), X.is_open_plan("status").alias("open_plan"),
        X.compound_key("shelf_id", "event_type").alias("key"), X.supplier_lot("shelf_id", F.to_date("created_at")).alias("lot"),
        X.numbered_lot("alert_id").alias("code"), X.one_of("status", ("open", "ack")).alias("allowed"),
    )


def q_casts(i: Inputs):
    e = i.sql("SELECT event_id, value, event_type, props FROM events")
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return e.select(
        "event_id", K.number(text).alias("number"), K.number_or(F.when(F.col("event_type") != "error", (F.col("event_id") % 50).cast("string")), -1).alias("with_default"),
        K.positive(F.col("event_id") % 5 - 2).alias("positive"), K.flag(F.col("event_type") == "view").alias("is_view"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )


def q_stock(i: Inputs):
    inv = i["inventory"]
    c, size, stock = F.col("maximum_stock"), F.col("standard_batch_size"), F.col("current_stock")
    some = F.when(F.col("item_category") == "LARGE", 0).when(F.col("item_category") == "SMALL", None).otherwise(c)
    return inv.select(
        "shelf_id", F.round(S.stock_pct(stock, some), 6).alias("pct"), S.target_qty(c, 75.0).cast("bigint").alias("target"),
        S.suggested_qty(stock, some, size).cast("bigint").alias("suggested"),
        S.needs_refill(stock, S.stock_pct(stock, some), F.lit(80.0), size * 10).alias("refill"),
        S.round_up_to_batch(stock, F.when(F.col("item_category") != "PROMO", size), 3).cast("bigint").alias("rounded"),
        S.capacity_in_batches(F.col("item_weight").cast("int"), size, up=True).cast("bigint").alias("cap_up"),
        S.capacity_in_batches(F.col("item_weight").cast("int"), size, up=False).cast("bigint").alias("cap_down"),
        F.round(S.safe_ratio(stock, some), 6).alias("ratio"), S.reorder_point(some, stock).alias("reorder"),
        F.round(S.base_daily_demand(c, "item_price", S.category_demand("item_category")), 6).alias("demand"),
        S.fallback_batches(stock, c, "warehouse_capacity", F.lit(1), size).alias("fallback"),
        S.cover_qty("item_weight", 2.5).cast("bigint").alias("cover"),
    )


def q_season(i: Inputs):
    o = i.sql("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
    return o.select("o_orderkey", S.season_factor("day").alias("season"), S.weekend_factor("day").alias("weekend"))


QUERIES = {
    "expr_time": q_time, "expr_money": q_money, "expr_text": q_text, "expr_casts": q_casts, "expr_stock": q_stock, "expr_season": q_season,
}

_dow = "(dayofweek(ts) + 6) % 7"
_some = "CASE item_category WHEN 'LARGE' THEN 0 WHEN 'SMALL' THEN NULL ELSE maximum_stock END"
_size3 = "(CASE WHEN item_category <> 'PROMO' THEN standard_batch_size END * 3)"

ORACLES = {
    "expr_time": oracle(
        f"""SELECT event_id, strftime(ts, '%G-W%V') AS week, {_dow} >= 5 AS weekend, CAST({_dow} AS INT) AS dow, {_dow} IN (1, 4) AS inbound,
            CASE WHEN hour(ts) < 7 THEN '00:00–06:59' WHEN hour(ts) < 10 THEN '07:00–09:59' WHEN hour(ts) < 14 THEN '10:00–13:59'
                 WHEN hour(ts) < 17 THEN '14:00–16:59' WHEN hour(ts) < 20 THEN '17:00–19:59' ELSE '20:00–23:59' END AS part,
            ts - INTERVAL '1' HOUR AS hour_ago, CAST(CAST(ts AS DATE) + 9 - DATE '2024-01-10' AS INT) AS days_left,
            date_trunc('second', ts) AS from_s, date_trunc('second', ts) AS from_ms, CAST(ts AS DATE) AS ms_day, date_trunc('second', ts) AS zulu,
            date_trunc('second', ts) - INTERVAL '2' HOUR AS "offset", CAST(NULL AS TIMESTAMP) AS bad, strftime(ts, '%Y%m%d_%H%M%S') AS version,
            date_trunc('second', ts) AS version_ts, strftime(ts, '%Y%m%d_%H%M%S') AS path_version,
            {_dow} IN (6, 1, 3) AND hour(ts) = 12 AND minute(ts) = 0 AS at_cutoff,
            {_dow} IN (6, 1, 3) AND hour(ts) * 60 + minute(ts) >= 715 AS in_window FROM events"""),
    "expr_money": oracle(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, ROUND(1 - (1 - l_discount) * (1 - l_tax), 6) AS compound,
           ROUND(GREATEST(0, LEAST(0.95, 1 - (1 - l_discount) * (1 - l_tax * 12))), 6) AS checkout, ROUND(LEAST(0.90, l_discount + l_tax), 6) AS added,
           GREATEST(l_discount, l_tax) AS larger, ROUND(CASE WHEN l_quantity / 2 > 1 THEN l_quantity / 200 ELSE l_quantity / 2 END, 6) AS fraction,
           ROUND(CASE WHEN l_quantity > 1 THEN 1 - (l_quantity / 2) / (l_quantity - 1) END, 6) AS from_prices,
           CAST(ROUND(CAST(l_quantity AS DECIMAL(10,0)) * 1.01 * (1 - CAST(l_discount AS DECIMAL(3,2))), 2) AS DOUBLE) AS total FROM lineitem"""),
    "expr_text": oracle(
        """SELECT alert_id, CASE WHEN s IN ('open','active','pending','new') THEN 'open' WHEN s IN ('ack','acknowledged') THEN 'ack'
             WHEN s IN ('resolved','closed','done') THEN 'resolved' WHEN s IN ('dismissed','ignored') THEN 'dismissed' ELSE 'ack' END AS normal,
           s IN ('open','active','pending') AS active, l LIKE '%store%' OR l LIKE '%shop%' AS store, l LIKE '%warehouse%' OR l LIKE 'wh%' AS warehouse,
           upper(l) AS place, s IN ('pending','issued') AS open_plan, shelf_id || '::' || event_type AS key,
           'SUP-' || strftime(created_at, '%Y%m%d') || '-' || shelf_id || '-1' AS lot, 'B' || lpad(alert_id, 7, '0') AS code,
           CASE WHEN status IN ('open','ack') THEN status END AS allowed
           FROM (SELECT *, lower(trim(status)) AS s, lower(trim(location)) AS l FROM alert_history)""", "alert_history"),
    "expr_casts": oracle(
        """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS number, CASE WHEN event_type <> 'error' THEN event_id % 50 ELSE -1 END AS with_default,
           CASE WHEN event_id % 5 > 2 THEN CAST(event_id % 5 - 2 AS INT) END AS positive, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS is_view,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events"""),
    "expr_stock": oracle(
        f"""SELECT shelf_id, ROUND(CASE WHEN cap0 > 0 THEN current_stock * 100.0 / cap0 END, 6) AS pct, CAST(CEIL(maximum_stock * 0.75) AS BIGINT) AS target,
            CAST(CASE WHEN cap0 IS NOT NULL THEN GREATEST(0, CEIL(cap0 * 0.8) - current_stock) ELSE GREATEST(0, standard_batch_size - current_stock) END AS BIGINT) AS suggested,
            COALESCE(CASE WHEN cap0 > 0 THEN current_stock * 100.0 / cap0 END < 80, FALSE) OR current_stock < standard_batch_size * 10 AS refill,
            CAST(CASE WHEN {_size3} > 0 THEN CEIL(current_stock / {_size3}) * {_size3} ELSE current_stock END AS BIGINT) AS rounded,
            CAST(CEIL(GREATEST(item_weight, 2 * standard_batch_size) / standard_batch_size) * standard_batch_size AS BIGINT) AS cap_up,
            CAST(FLOOR(GREATEST(item_weight, 2 * standard_batch_size) / standard_batch_size) * standard_batch_size AS BIGINT) AS cap_down,
            ROUND(CASE WHEN cap0 > 0 THEN current_stock / cap0 ELSE 0 END, 6) AS ratio,
            CAST(GREATEST(1, ROUND(CAST(COALESCE(cap0, current_stock) AS DECIMAL(18,0)) * 0.05)) AS INT) AS reorder,
            ROUND(GREATEST(0.2, 0.03 * maximum_stock / (1 + 0.1 * GREATEST(item_price - 2, 0)) * 0.6), 6) AS demand,
            CAST(FLOOR(LEAST(CEIL(gap / standard_batch_size) * standard_batch_size, GREATEST(0, warehouse_capacity - current_stock)) / standard_batch_size) AS INT) AS fallback,
            CAST(CEIL(item_weight * 2.5) AS BIGINT) AS cover
            FROM (SELECT *, {_some} AS cap0, CASE WHEN maximum_stock <= current_stock THEN standard_batch_size ELSE maximum_stock - current_stock END AS gap FROM inventory)""",
        "inventory"),
    "expr_season": oracle(
        """SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) IN (6, 7, 8) THEN 1.10 WHEN month(o_orderdate) = 12 THEN 1.15 ELSE 1.0 END AS DOUBLE) AS season,
           CAST(CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1.10 ELSE 1.0 END AS DOUBLE) AS weekend FROM orders"""),
}
