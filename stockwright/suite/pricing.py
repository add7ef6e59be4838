"""Queries over discounts, receipts and carts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import iso_week
from ..plans import discounts as D, sales as S
from .fixtures import Inputs, now_ts, oracle, today
from .alerting import uuid_sql
from .state import DAY, TS

r6 = lambda c: F.round(c, 6).alias(c)
CART_ORDER = ["ts", "seq1", "seq2", "seq3", "seq4"]


def daily(i: Inputs):
    return D.daily_discount(i.store_lots, i["daily_discounts"], today(), now_ts())


def q_daily(i: Inputs):
    return daily(i)[0].select("shelf_id", "discount_date", r6("discount"), "created_at")


def q_daily_again(i: Inputs):
    """The discount table after two runs of a day, where rows tell which job wrote them: the second changes nothing."""
    existing = i["daily_discounts"].select("shelf_id", "discount_date", "discount", F.lit("weekly").alias("source"))
    once = D.daily_discount(i.store_lots, existing, today(), now_ts())[1]
    return D.daily_discount(i.store_lots, once, today(), now_ts())[1].select("shelf_id", "discount_date", r6("discount"), "source")


def q_daily_table(i: Inputs):
    return daily(i)[1].select("shelf_id", "discount_date", r6("discount"))


def q_effective(i: Inputs):
    promo = D.weekly_to_daily(i["weekly_discounts"])
    return D.effective(promo, i["daily_discounts"], "add").select("shelf_id", "discount_date", r6("discount"))


def q_effective_max(i: Inputs):
    promo = D.weekly_to_daily(i["weekly_discounts"])
    return D.effective(promo, i["daily_discounts"], "max").select("shelf_id", "discount_date", r6("discount"))


def carts_sold(i: Inputs):
    return i["receipt_lines"].groupBy(F.col("transaction_id").alias("cart_id"), "item_id").agg(
        F.sum("quantity").cast("int").alias("quantity"), F.max("ts").alias("ts")
    )


def priced(i: Inputs):
    on_day = i["daily_discounts"].where(F.col("discount_date") == today()).groupBy("shelf_id").agg(F.max("discount").alias("discount"))
    return S.price_receipts(carts_sold(i), i["inventory"], D.discount_on(i["weekly_discounts"], today()), on_day, i.store_lots, ["ts"])


def q_totals(i: Inputs):
    return S.receipt_totals(priced(i)).select("cart_id", "total_items", F.round("total_amount", 2).alias("total_amount"))


def q_cart(i: Inputs):
    return S.cart_state(i["shelf_events"], CART_ORDER)


def q_checkouts(i: Inputs):
    return S.checkouts(i["shelf_events"], i["shop_visits"], now_ts(), ["seq1", "seq2", "seq3", "seq4"])


def q_week(i: Inputs):
    weeks = i["weekly_discounts"].withColumn("week", iso_week("week_start"))
    return D.discount_in_week(weeks, today()).select("shelf_id", r6("discount"))


def checkouts_of_orders(i: Inputs):
    return i.sql("SELECT o_orderkey AS cart_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS checkout_ts FROM orders")


def q_whole(i: Inputs):
    """Each receipt as one message with all its lines."""
    total = F.aggregate("items", F.lit(0).cast("decimal(18,2)"), lambda a, x: (a + x["total_price"].cast("decimal(18,2)")).cast("decimal(18,2)"))
    return S.receipts(priced(i), checkouts_of_orders(i)).select(
        "transaction_id", "customer_id", "timestamp", "part", F.size("items").alias("n_lines"),
        F.get("items", F.lit(0))["item_id"].alias("first_item"), F.round(total.cast("double"), 2).alias("total"))


def q_messages(i: Inputs):
    """Receipts as messages of at most three lines, summed up again per message."""
    m = S.receipts(priced(i), checkouts_of_orders(i), per_message=3)
    units = F.aggregate("items", F.lit(0), lambda a, x: a + x["quantity"])
    return m.groupBy("transaction_id", "customer_id", "timestamp").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.size("items")).alias("n_lines"), F.sum(units).alias("units"), F.max(F.size("items")).alias("longest"))


QUERIES = {
    "receipt_messages": q_messages,
    "receipt_whole": q_whole,
    "receipt_rows": lambda i: S.receipt_rows(priced(i), checkouts_of_orders(i)).drop("cart_id"),
    "discount_in_week": q_week,
    "daily_discount": q_daily,
    "daily_discount_table": q_daily_table,
    "daily_discount_again": q_daily_again,
    "discount_alerts": lambda i: daily(i)[2],
    "weekly_to_daily_discount": lambda i: D.weekly_to_daily(i["weekly_discounts"]).select("shelf_id", "discount_date", r6("discount")),
    "discount_on_date": lambda i: D.discount_on(i["weekly_discounts"], today()).select("shelf_id", r6("discount")),
    "effective_discount": q_effective,
    "effective_discount_max": q_effective_max,
    "discount_in_next_7d": lambda i: D.discounted_next(i["daily_discounts"], today()),
    "receipt_pricing": priced,
    "receipt_totals": q_totals,
    "cart_state": q_cart,
    "checkouts": q_checkouts,
}

_soon = f"SELECT DISTINCT shelf_id, expiry_date FROM wh_lots WHERE qty > 0 AND expiry_date BETWEEN {DAY} AND {DAY} + 1"
_days = f"""SELECT shelf_id, {DAY} AS discount_date FROM soon UNION SELECT shelf_id, {DAY} + 1 FROM soon WHERE expiry_date = {DAY} + 1"""
_pick = "CAST('0x' || substr(sha1(d.shelf_id || '|' || strftime(d.discount_date, '%Y-%m-%d')), 1, 8) AS BIGINT) % 3"
_fresh = f"""SELECT d.shelf_id, d.discount_date, 1 - (1 - COALESCE(e.discount, 0)) * (1 - CAST(0.3 + 0.1 * ({_pick}) AS DOUBLE)) AS discount
  FROM days d LEFT JOIN daily_discounts e ON d.shelf_id = e.shelf_id AND d.discount_date = e.discount_date"""
DAILY_PARTS = {"soon": _soon, "days": _days, "fresh": _fresh}
_promo = """SELECT shelf_id, discount_date, MAX(CASE WHEN discount_pct > 1 THEN discount_pct / 100 ELSE discount_pct END) AS discount FROM
  (SELECT shelf_id, discount_pct, CAST(UNNEST(generate_series(CAST(week_start AS TIMESTAMP), CAST(week_end AS TIMESTAMP) -
     CASE WHEN week_end - week_start = 7 THEN INTERVAL '1' DAY ELSE INTERVAL '0' DAY END, INTERVAL '1' DAY)) AS DATE) AS discount_date
   FROM weekly_discounts) GROUP BY shelf_id, discount_date"""
_on_day = f"""SELECT shelf_id, MAX(CASE WHEN discount_pct > 1 THEN discount_pct / 100 ELSE discount_pct END) AS discount
  FROM weekly_discounts WHERE {DAY} BETWEEN week_start AND week_end GROUP BY shelf_id"""
_eff = lambda e: f"""SELECT * FROM (SELECT COALESCE(p.shelf_id, f.shelf_id) AS shelf_id, COALESCE(p.discount_date, f.discount_date) AS discount_date,
  ROUND({e}, 6) AS discount FROM promo p FULL JOIN daily_discounts f ON p.shelf_id = f.shelf_id AND p.discount_date = f.discount_date) WHERE discount > 0"""
_cart = """SELECT transaction_id AS cart_id, item_id AS shelf_id, CAST(SUM(quantity) AS INT) AS need, MAX(ts) AS ts FROM receipt_lines
  GROUP BY transaction_id, item_id"""
_cl = "SELECT *, SUM(need) OVER (PARTITION BY shelf_id ORDER BY ts, cart_id ROWS UNBOUNDED PRECEDING) AS d1 FROM cart"
_ll = """SELECT *, SUM(qty) OVER (PARTITION BY shelf_id ORDER BY expiry_date, batch_code ROWS UNBOUNDED PRECEDING) AS s1 FROM wh_lots WHERE qty > 0"""
_taken = """SELECT c.cart_id, c.shelf_id, l.batch_code, l.expiry_date, LEAST(c.d1, l.s1) - GREATEST(c.d1 - c.need, l.s1 - l.qty) AS q
  FROM cl c JOIN ll l ON c.shelf_id = l.shelf_id AND LEAST(c.d1, l.s1) > GREATEST(c.d1 - c.need, l.s1 - l.qty)"""
_rest = """SELECT c.cart_id, c.shelf_id, c.need - COALESCE(SUM(t.q), 0) AS q FROM cart c LEFT JOIN taken t
  ON c.cart_id = t.cart_id AND c.shelf_id = t.shelf_id GROUP BY c.cart_id, c.shelf_id, c.need"""
_lines = """SELECT cart_id, shelf_id, batch_code, expiry_date, q FROM taken UNION ALL SELECT cart_id, shelf_id, NULL, NULL, q FROM rest WHERE q > 0"""
_priced = f"""SELECT cart_id, item_id, batch_code, CAST(q AS INT) AS quantity, CAST(p AS DOUBLE) AS unit_price, CAST(d AS DOUBLE) AS discount,
  CAST(ROUND(CAST(q AS DECIMAL(10,0)) * p * (1 - d), 2) AS DOUBLE) AS total_price, expiry_date
  FROM (SELECT l.cart_id, l.shelf_id AS item_id, l.batch_code, l.q, l.expiry_date,
    CAST(ROUND(CAST(COALESCE(i.item_price, 5.0) AS DECIMAL(18,4)), 2) AS DECIMAL(12,2)) AS p,
    CAST(ROUND(CAST(GREATEST(0, LEAST(0.95, 1 - (1 - COALESCE(w.discount, 0)) * (1 - COALESCE(x.discount, 0)))) AS DECIMAL(18,4)), 2) AS DECIMAL(3,2)) AS d
    FROM lines l LEFT JOIN inventory i ON l.shelf_id = i.shelf_id LEFT JOIN on_day w ON l.shelf_id = w.shelf_id
    LEFT JOIN (SELECT shelf_id, MAX(discount) AS discount FROM daily_discounts WHERE discount_date = {DAY} GROUP BY shelf_id) x ON l.shelf_id = x.shelf_id)"""
PRICE_FIX = ("receipt_lines", "wh_lots", "inventory", "weekly_discounts", "daily_discounts")
PRICE_PARTS = {"cart": _cart, "cl": _cl, "ll": _ll, "taken": _taken, "rest": _rest, "lines": _lines, "on_day": _on_day, "priced": _priced}
_steps = """SELECT customer_id, item_id, ts, seq1, seq2, seq3, seq4, CASE WHEN event_type = 'pickup' THEN quantity ELSE -quantity END AS step
  FROM shelf_events WHERE event_type IN ('pickup', 'putback')"""
_walk = lambda keys, src: f"""SELECT {keys}, step, SUM(step) OVER (PARTITION BY {keys} ORDER BY ts, seq1, seq2, seq3, seq4 ROWS UNBOUNDED PRECEDING) AS run FROM {src}"""
_held = "CAST(SUM(step) - LEAST(0, MIN(run)) AS BIGINT) AS quantity"
_visited = f"""SELECT v.visit_id, v.checkout_ts, e.* FROM steps e ASOF JOIN
  (SELECT visit_id, customer_id, entry_time, CASE WHEN exit_time <= {TS} THEN exit_time WHEN entry_time < {TS} - INTERVAL '3' HOUR THEN {TS} END AS checkout_ts
   FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, entry_time ORDER BY visit_id DESC) AS rn FROM shop_visits) WHERE rn = 1) v
  ON e.customer_id = v.customer_id AND e.ts >= v.entry_time WHERE e.ts <= v.checkout_ts"""

_numbered = """SELECT *, ROW_NUMBER() OVER (PARTITION BY cart_id ORDER BY item_id, COALESCE(batch_code, ''), COALESCE(CAST(expiry_date AS VARCHAR), ''), quantity) AS line_no
  FROM priced"""
_receipt_id = uuid_sql("'receipt:' || CAST(cart_id AS STRING)")

ORACLES = {
    "receipt_whole": oracle(
        f"""SELECT {_receipt_id} AS transaction_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
            0 AS part, CAST(n AS INT) AS n_lines, first_item, total FROM
            (SELECT cart_id, COUNT(*) AS n, MIN(item_id) AS first_item, ROUND(CAST(SUM(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE), 2) AS total FROM priced GROUP BY cart_id)
            JOIN orders ON cart_id = o_orderkey""", *PRICE_FIX, **PRICE_PARTS),
    "receipt_rows": oracle(
        f"""SELECT {_receipt_id} AS transaction_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
            line_no, item_id, batch_code, quantity, unit_price, discount, total_price, expiry_date FROM numbered JOIN orders ON cart_id = o_orderkey""",
        *PRICE_FIX, **PRICE_PARTS, numbered=_numbered),
    "receipt_messages": oracle(
        f"""SELECT {uuid_sql("'receipt:' || CAST(cart_id AS STRING)")} AS transaction_id, 'C' || CAST(o_custkey AS STRING) AS customer_id,
            CAST(o_orderdate AS TIMESTAMP) AS "timestamp", (n + 2) // 3 AS messages, n AS n_lines, units, CAST(LEAST(n, 3) AS INT) AS longest
            FROM (SELECT cart_id, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS units FROM priced GROUP BY cart_id) JOIN orders ON cart_id = o_orderkey""",
        *PRICE_FIX, **PRICE_PARTS),
    "discount_in_week": oracle(
        f"""SELECT shelf_id, ROUND(MAX(CASE WHEN discount_pct > 1 THEN discount_pct / 100 ELSE discount_pct END), 6) AS discount
            FROM weekly_discounts WHERE strftime(week_start, '%G-%V') = strftime({DAY}, '%G-%V') GROUP BY shelf_id""", "weekly_discounts"),
    "daily_discount": oracle(f"SELECT shelf_id, discount_date, ROUND(discount, 6) AS discount, {TS} AS created_at FROM fresh",
                             "wh_lots", "daily_discounts", **DAILY_PARTS),
    "daily_discount_table": oracle(
        """SELECT shelf_id, discount_date, ROUND(discount, 6) AS discount FROM fresh UNION ALL
           SELECT shelf_id, discount_date, discount FROM daily_discounts e WHERE NOT EXISTS
           (SELECT 1 FROM fresh f WHERE f.shelf_id = e.shelf_id AND f.discount_date = e.discount_date)""", "wh_lots", "daily_discounts", **DAILY_PARTS),
    "daily_discount_again": oracle(
        """SELECT shelf_id, discount_date, ROUND(discount, 6) AS discount, 'expiry' AS source FROM fresh UNION ALL
           SELECT shelf_id, discount_date, ROUND(discount, 6), 'weekly' FROM daily_discounts""", "wh_lots", "daily_discounts", **DAILY_PARTS),
    "discount_alerts": oracle(
        f"SELECT DISTINCT 'near_expiry_discount' AS event_type, shelf_id, 'store' AS location, {TS} AS created_at FROM soon", "wh_lots", soon=_soon),
    "weekly_to_daily_discount": oracle("SELECT shelf_id, discount_date, ROUND(discount, 6) AS discount FROM promo", "weekly_discounts", promo=_promo),
    "discount_on_date": oracle("SELECT shelf_id, ROUND(discount, 6) AS discount FROM on_day", "weekly_discounts", on_day=_on_day),
    "effective_discount": oracle(_eff("LEAST(0.90, COALESCE(p.discount, 0) + COALESCE(f.discount, 0))"), "weekly_discounts", "daily_discounts", promo=_promo),
    "effective_discount_max": oracle(_eff("GREATEST(COALESCE(p.discount, 0), COALESCE(f.discount, 0))"), "weekly_discounts", "daily_discounts", promo=_promo),
    "discount_in_next_7d": oracle(
        f"SELECT DISTINCT shelf_id, TRUE AS is_discounted_next_7d FROM daily_discounts WHERE discount > 0 AND discount_date BETWEEN {DAY} AND {DAY} + 6",
        "daily_discounts"),
    "receipt_pricing": oracle("SELECT * FROM priced", *PRICE_FIX, **PRICE_PARTS),
    "receipt_totals": oracle(
        """SELECT cart_id, CAST(SUM(quantity) AS INT) AS total_items, CAST(SUM(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
           FROM priced GROUP BY cart_id""", *PRICE_FIX, **PRICE_PARTS),
    "cart_state": oracle(f"SELECT customer_id, item_id, {_held} FROM walk GROUP BY customer_id, item_id", "shelf_events",
                         steps=_steps, walk=_walk("customer_id, item_id", "steps")),
    "checkouts": oracle(
        f"SELECT visit_id, checkout_ts, customer_id, item_id, {_held} FROM walk GROUP BY visit_id, checkout_ts, customer_id, item_id HAVING SUM(step) - LEAST(0, MIN(run)) > 0",
        "shelf_events", "shop_visits", steps=_steps, visited=_visited, walk=_walk("visit_id, checkout_ts, customer_id, item_id", "visited")),
}
