"""The inventory jobs as streams; each uses the same functions as its batch form."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import apply_status, exclude_recent, replace_rows, upsert
from ..plans.alerts import ALERT_KEY, alert_rows, keep_open_plans, shelf_alerts, split_alert_feed, wh_alerts
from ..plans.inventory import SHELF_SIGN, WH_SIGN, add_deltas, lots_after_sales, lots_after_wh_events, shelf_deltas, signed, wh_deltas
from ..plans.planning import issue_restock, refill_queue, shelf_events_of
from ..plans.routing import route
from ..plans.sales import cart_moves, checkout_time, held
from ..schemas import ALERTS, RESTOCK_PLAN, SHELF_STATE, WH_STATE, columns
from ..sources.sinks import append_batch
from .runner import append_stream, changelog_sink, changelog_table, keyed, run_stream, same_keys, stateful, stateless


def running_deltas(events: DataFrame, qty: str, signs: dict[str, int]) -> DataFrame:
    """Net change per shelf since the start, as a streaming aggregate (update mode emits touched shelves)."""
    return events.groupBy("shelf_id").agg(F.sum(signed(qty, signs)).alias("delta"), F.max("ts").alias("event_ts"))


def shelf_delta_stream(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return run_stream(running_deltas(events, "quantity", SHELF_SIGN), changelog_sink(out, "shelf_state"), checkpoint, "update")


def wh_delta_stream(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return run_stream(running_deltas(events, "qty", WH_SIGN), changelog_sink(out, "wh_state"), checkpoint, "update")


def shelf_state_job(state_path: str, out: str, opening: DataFrame, profiles: DataFrame, now: Column, **options):
    """Shelf state kept in a table; each batch also publishes the shelves it changed."""

    def step(state: DataFrame, rows: DataFrame):
        deltas = shelf_deltas(rows).join(profiles.select("shelf_id", "item_weight"), "shelf_id", "left")
        after = add_deltas(state, deltas, "current_stock", now, {"item_weight": F.col("s.item_weight")})
        return after, after.join(deltas.select("shelf_id"), "shelf_id", "left_semi")

    return keyed(state_path, SHELF_STATE, ["shelf_id"], same_keys(["shelf_id"]), step, opening, out, "shelf_state", **options)


def wh_state_job(state_path: str, out: str, opening: DataFrame, now: Column, **options):
    def step(state: DataFrame, rows: DataFrame):
        deltas = wh_deltas(rows)
        after = add_deltas(state, deltas, "wh_current_stock", now)
        return after, after.join(deltas.select("shelf_id"), "shelf_id", "left_semi")

    return keyed(state_path, WH_STATE, ["shelf_id"], same_keys(["shelf_id"]), step, opening, out, "wh_state", **options)


LOT_KEY = ["shelf_id", "batch_code"]


def store_lot_sales_job(state_path: str, opening: DataFrame, **options):
    """Store lots lowered by the receipt lines of each batch."""
    step = lambda state, lines: (lots_after_sales(lines, state), None)
    lot_of = lambda lines: lines.select(F.col("item_id").alias("shelf_id"), "batch_code")
    return keyed(state_path, opening.schema, LOT_KEY, same_keys(LOT_KEY, lot_of), step, opening, app="lot_sales", **options)


def lot_events_job(wh_path: str, store_path: str, wh_opening: DataFrame, store_opening: DataFrame, **options):
    """Warehouse and store lots moved by the events of each batch; two state tables from one batch."""
    wh_step = lambda state, ev: (lots_after_wh_events(ev, state, store_opening.limit(0))[0], None)
    to_store = lambda ev: ev.where("event_type = 'wh_out'")  # nothing else reaches the store, so nothing else is dealt by lot
    store_step = lambda state, ev: (lots_after_wh_events(to_store(ev), wh_opening.limit(0), state)[1], None)
    warehouse = keyed(wh_path, wh_opening.schema, LOT_KEY, same_keys(LOT_KEY), wh_step, wh_opening, app="lot_events", **options)
    store = keyed(store_path, store_opening.schema, LOT_KEY, same_keys(LOT_KEY, to_store), store_step, store_opening, app="lot_events", **options)

    def both(rows: DataFrame, batch_id: int) -> None:
        warehouse(rows, batch_id)
        store(rows, batch_id)

    return both


REFILL_STATE = columns(
    "event_id string, shelf_id string, batch_code string, qty int, item_weight double, ts timestamp, "
    "available_at timestamp, seen_ts timestamp"
)


def delayed_refill_job(state_path: str, out: str, profiles: DataFrame, delay_min: int = 3, now: Column | None = None):
    """Warehouse exits become shelf events a few minutes later.

    Goods on their way are the state; rows leave it once the time has come, late arrivals at
    once. Time is the given one, or the latest event time seen so far. There is no grouping by
    shelf anywhere, so a busy shelf is no different from a quiet one.
    """

    def step(state: DataFrame, rows: DataFrame):
        queue = refill_queue(rows, profiles, delay_min).withColumn("seen_ts", F.lit(None).cast("timestamp"))
        waiting = state.where("event_id is not null").unionByName(queue)
        seen = F.greatest(state.agg(F.max("seen_ts")).scalar(), rows.agg(F.max("ts")).scalar())
        clock = now if now is not None else seen
        due = F.col("available_at") <= clock
        # One marker row carries the clock to the next batch.
        mark = rows.sparkSession.range(1).select(*[
            (seen if f.name == "seen_ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in REFILL_STATE
        ])
        left = waiting.where(~F.coalesce(due, F.lit(False))).unionByName(mark)
        return left, shelf_events_of(waiting.where(due))

    return stateful(state_path, REFILL_STATE, step, out, "refill")


CART_KEY = ["customer_id", "item_id"]
CART_STATE = columns("customer_id string, item_id string, quantity bigint, last_ts timestamp")


def cart_job(state_path: str, out: str, order: list[str], visits: DataFrame | None = None, now: Column | None = None,
             max_age_h: int = 3, **options):
    """Items held per customer. Each batch of events is one step per (customer, item): its sum and its
    lowest running sum, applied to the quantity held before.

    With visits (customer_id, entry_time, exit_time) a customer's latest visit that has begun by the latest event time
    decides: if it has ended, or began more than max_age_h before, their items are emitted with the time of checkout and
    the cart is emptied. The batch's events are taken as they arrive.
    """

    def gone(clock: Column) -> DataFrame:
        begun = visits.where(F.col("entry_time") <= clock)
        latest = begun.groupBy("customer_id").agg(F.max(F.struct("entry_time", "exit_time")).alias("v"))
        left = latest.select("customer_id", checkout_time(F.col("v.entry_time"), F.col("v.exit_time"), clock, max_age_h).alias("checkout_ts"))
        return left.where("checkout_ts is not null")

    def clock_of(rows: DataFrame) -> Column:
        return now if now is not None else rows.agg(F.max("ts")).scalar()

    def pick(state: DataFrame, rows: DataFrame) -> DataFrame:
        mine = rows.select(*CART_KEY).distinct().withColumn("_mine", F.lit(True))
        marked = state.join(mine, CART_KEY, "left")
        if visits is None:
            return marked.where("_mine")
        left = gone(clock_of(rows)).select("customer_id", F.lit(True).alias("_left"))
        return marked.join(left, "customer_id", "left").where("_mine or (_left and quantity > 0)")

    def step(state: DataFrame, rows: DataFrame):
        moves = cart_moves(rows, CART_KEY, order)
        last = rows.groupBy(*CART_KEY).agg(F.max("ts").alias("ts"))
        both = moves.join(last, CART_KEY)
        start = F.coalesce(F.col("t.quantity"), F.lit(0))
        carts = upsert(
            state, both, CART_KEY,
            on_match={"quantity": held(start, F.col("s.net"), F.col("s.low")), "last_ts": F.greatest(F.col("t.last_ts"), F.col("s.ts"))},
            on_insert={"quantity": held(F.lit(0), F.col("s.net"), F.col("s.low")), "last_ts": F.col("s.ts")},
        )
        if visits is None:
            return carts, None
        clock = clock_of(rows)
        marked = carts.join(gone(clock).withColumn("_left", F.lit(True)), "customer_id", "left")
        leaving = marked.where("_left and quantity > 0").select(*carts.columns, "checkout_ts")
        emptied = marked.withColumn("quantity", F.when(F.col("_left"), 0).otherwise(F.col("quantity")))
        return emptied.select(*carts.columns), leaving

    return keyed(state_path, CART_STATE, CART_KEY, pick, step, out=out, app="cart", **options)


Table = Callable[[], DataFrame]


def shelf_alert_job(out: str, policies: Table, capacity: Table, lots: Table, history: Table, now: Column | None = None, **params):
    """Alerts and restock plans for the shelves whose state changed in a batch.

    The tables are read anew for each batch. Time is the given one, or the latest change of the batch.
    """

    def step(rows: DataFrame):
        clock = now if now is not None else rows.agg(F.max("last_update_ts")).scalar()
        alerts, plans = shelf_alerts(rows, policies(), capacity(), lots(), history(), clock, **params)
        return {"alerts": alerts, "plans": plans}

    return stateless(out, step, "shelf_alerts")


def wh_alert_job(out: str, policies: Table, lots: Table, sizes: Table, history: Table, now: Column | None = None, **params):
    """Alerts, resolve events and supplier plans for the warehouse items whose state changed in a batch."""

    def step(rows: DataFrame):
        clock = now if now is not None else rows.agg(F.max("last_update_ts")).scalar()
        alerts, resolved, plans = wh_alerts(rows, policies(), lots(), sizes(), history(), clock, **params)
        return {"alerts": alerts, "resolved": resolved, "plans": plans}

    return stateless(out, step, "wh_alerts")


def restock_job(state_path: str, out: str, lots: Table, now: Column | None = None, min_age_s: int = 60, **options):
    """Plans are kept until they are old enough, then served from the lots; a young plan waits for a later batch.

    Time is the given one, or the latest creation time seen. A batch looks at its own plans and at
    those still pending, not at the plans of the past.
    """

    def pick(state: DataFrame, rows: DataFrame) -> DataFrame:
        mine = rows.select("plan_id").distinct().withColumn("_mine", F.lit(True))
        return state.join(mine, "plan_id", "left").where("status = 'pending' or _mine")

    def step(state: DataFrame, rows: DataFrame):
        plans = replace_rows(state, rows.select(*RESTOCK_PLAN.names), ["plan_id"])
        clock = now if now is not None else plans.agg(F.max("created_at")).scalar()
        wh_out, after, acks = issue_restock(plans, lots(), clock, min_age_s)
        return after, {"wh_out": wh_out, "acks": acks}

    return keyed(state_path, RESTOCK_PLAN, ["plan_id"], pick, step, out=out, app="restock", **options)


def alert_sink_job(state_path: str, opening: DataFrame, now: Column, **options):
    """The one writer of the alert table: new alerts are added, status changes applied (rows carry seq).

    A batch looks at the alerts it names and at those of the places it names.
    """

    def pick(state: DataFrame, feed: DataFrame) -> DataFrame:
        new, changes = split_alert_feed(feed)
        ids = alert_rows(new, now).select("alert_id").union(changes.select("alert_id")).where("alert_id is not null")
        places = changes.where("alert_id is null").select("shelf_id", "location")
        mark = lambda df, c: df.distinct().withColumn(c, F.lit(True))
        named = state.join(mark(ids, "_named"), "alert_id", "left").join(mark(places, "_placed"), ["shelf_id", "location"], "left")
        return named.where("_named or _placed")

    def step(state: DataFrame, feed: DataFrame):
        new, changes = split_alert_feed(feed)
        # Alerts of one place and time are the same alert, however often they arrive.
        table = replace_rows(state, alert_rows(new, now).dropDuplicates(["alert_id"]), ["alert_id"])
        return apply_status(table, changes, now), None

    return keyed(state_path, ALERTS, ["alert_id"], pick, step, opening, app="alert_sink", **options)


COOLDOWN_STATE = T.StructType([ALERTS[c] for c in ALERT_KEY] + [T.StructField("created_at", T.TimestampType())])


def cooldown_job(state_path: str, out: str, minutes: int = 60):
    """Alerts pass unless the same one was raised within the last minutes; the state holds the last time per alert.

    Rows carry created_at, the same for all rows of a batch.
    """

    def step(state: DataFrame, rows: DataFrame):
        now = rows.agg(F.max("created_at")).scalar()
        passed = exclude_recent(rows, state, ALERT_KEY, "created_at", now, minutes)
        last = passed.groupBy(*ALERT_KEY).agg(F.max("created_at").alias("created_at"))
        return last, passed

    return keyed(state_path, COOLDOWN_STATE, ALERT_KEY, same_keys(ALERT_KEY), step, out=out, app="alerts")


def deduplicated(source: DataFrame, id_col: str, ts_col: str, span: str) -> DataFrame:
    """The first row seen of each event id. Copies up to ``span`` apart in event time are always found; later ones may pass.

    The state is Spark's own and forgets ids as the watermark moves. A stream cannot take back a row it has sent, so the
    first copy counts here, and the last one in the batch form (``operators.latest.dedupe_events``).
    """
    return source.withWatermark(ts_col, span).dropDuplicatesWithinWatermark([id_col])


def open_plans_job(out: str, plans_of: Callable[[DataFrame, Column], DataFrame], ts_col: str = "last_update_ts"):
    """Fresh plans for the shelves of a batch, as a change log: the newest one per shelf counts (``open_plans``).

    The levels go to a log of their own first, and the plans are made from what that log holds of the batch. The rows are
    those of ``newest_levels``, so a shelf is there once, with its newest level. The time of the plans is that of the
    batch's latest level. A batch that is run again replaces its own plans.
    """

    def job(rows: DataFrame, batch_id: int) -> None:
        append_batch(rows, f"{out}/levels", batch_id, "levels")
        written = rows.sparkSession.read.schema(T.StructType([*rows.schema, T.StructField("batch_id", T.LongType())])).parquet(f"{out}/levels")
        levels = written.where(F.col("batch_id") == batch_id).drop("batch_id")
        append_batch(plans_of(levels, levels.agg(F.max(ts_col)).scalar()), f"{out}/plans", batch_id, "open_plans")

    return job


def newest_levels(levels: DataFrame, ts_col: str = "last_update_ts") -> DataFrame:
    """Newest row per shelf as a streaming aggregate (update mode emits the shelves that changed)."""
    rest = [c for c in levels.columns if c not in ("shelf_id", ts_col)]
    newest = levels.groupBy("shelf_id").agg(F.max(F.struct(ts_col, *rest)).alias("_row"))
    return newest.select("shelf_id", *[F.col("_row")[c].alias(c) for c in (*rest, ts_col)])


def open_plans(plans: DataFrame, log: DataFrame) -> DataFrame:
    """The plan table after the stream: at most one new plan per shelf, in place of a pending one, never of one issued."""
    return keep_open_plans(plans, changelog_table(log, ["shelf_id"]))


def router_job(out: str, mapping: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """Rows of named streams, written per topic."""

    def job(rows: DataFrame, batch_id: int) -> None:
        routed = route(rows, mapping).withColumns({"batch_id": F.lit(batch_id)})
        (
            routed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "batch_id").parquet(out)
        )

    return job


def raw_and(raw_path: str, app: str, job: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Two sinks from one batch: the rows as they came, then the job, reading the source once."""

    def both(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            append_batch(rows, raw_path, batch_id, app)
            job(rows, batch_id)
        finally:
            rows.unpersist()

    return both


def foot_traffic_stream(visits: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Typed visits into the raw table; rows without customer or entry time are left out."""
    return append_stream(visits.where("customer_id is not null and entry_time is not null"), path, checkpoint)
