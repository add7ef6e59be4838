"""What keeps jobs in proportion to their input: where the work is done, and how often."""
import random
import re
import zlib

import pandas as pd
import pytest
from helpers import day, ts
from pyspark.sql import functions as F

from stockwright.functions import ids
from stockwright.operators import ordered
from stockwright.plans import ml
from stockwright.streaming import timed
from stockwright.streaming.runner import append_stream
from stockwright.suite.fixtures import Inputs
from stockwright.suite.modelling import scored

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_draws_are_made_for_scored_rows_only(spark):
    """A filter on the batches must not carry the draws down to every feature row."""
    plans, log = ml.plan_orders(scored(Inputs(spark, FOLDER)), ml.MODEL, "v", day(), ts())
    for df in (plans, log.where("predicted_batches > 1")):
        text = plan(df)
        assert "Scan ExistingRDD" in text and "Join" not in text and "FileScan" not in text


def test_a_draw_takes_one_digest(spark):
    df = spark.createDataFrame([("k",), (None,), ("é",)], "k string").select("k", ids.uuid5_mod("k").alias("m"), ids.uuid5("k").alias("u"))
    assert len(re.findall(r"\bsha1?\(", plan(df.select("m")))) <= 1
    assert {r["k"]: r["m"] for r in df.collect()} == {r["k"]: r["u"] and int(r["u"].replace("-", ""), 16) % 1_000_000 for r in df.collect()}


def test_many_exits_share_few_states(spark, tmp_path):
    """Three thousand exits, each delivered twice, take at most as many states (and calls) as there are buckets."""
    exits = spark.range(1, 3001).selectExpr("concat('e', id) AS event_id", "'wh_out' AS event_type", "concat('s', id % 7) AS shelf_id", "'b' AS batch_code",
                                         "int(1 + id % 5) AS qty", "timestamp_seconds(id) AS ts")
    last = spark.range(1).selectExpr("'last' AS event_id", "'wh_out' AS event_type", "'s1' AS shelf_id", "'b' AS batch_code", "1 AS qty", "timestamp_seconds(9000) AS ts")
    exits.unionByName(exits).unionByName(last).write.parquet(f"{tmp_path}/in")
    profiles = spark.createDataFrame([(f"s{k}", 0.5) for k in range(6)], "shelf_id string, item_weight double")
    source = spark.readStream.schema(exits.schema).parquet(f"{tmp_path}/in")
    query = append_stream(timed.refill_stream(source, profiles), f"{tmp_path}/out", f"{tmp_path}/progress")
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= timed.BUCKETS
    out = spark.read.parquet(f"{tmp_path}/out")
    got = {r["event_id"]: r for r in out.where("event_type = 'weight_change'").collect()}
    assert len(got) == 3000 and out.count() == 6000 and "last" not in got
    assert got["e8"]["delta_weight"] == 2.0 and got["e6"]["delta_weight"] is None


class State:
    """Spark's state for one group."""

    def __init__(self):
        self.value, self.timer, self.now, self.hasTimedOut = None, None, 0, False

    exists = property(lambda s: s.value is not None)
    get = property(lambda s: s.value)

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.now

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):  # noqa: N802
        assert ms >= self.now
        self.timer = ms

    def call(self, step, key, rows, now):
        """One batch; a group without rows is called if the watermark has passed its timer."""
        self.now, self.hasTimedOut = now, not rows
        if self.hasTimedOut and (self.timer is None or self.timer >= now):
            return []
        self.timer = None
        return [tuple(r) for f in step(key, iter([pd.DataFrame(rows)] if rows else []), self) for r in f.astype(object).itertuples(index=False)]


M = timed.MINUTE
RULES = {
    "refill": (timed.refill_rule(20 * M), timed.REFILL_ROW, timed.REFILL, lambda r, t: {
        "shelf_id": "s", "batch_code": r.choice([None, "b"]), "qty": r.randrange(1, 9), "item_weight": 2.0, "ts_us": t, "due_us": t + 3 * M}),
    "cooldown": (timed.cooldown_rule(10 * M), ["created_us"], "event_id string, created_us bigint", lambda r, t: {"created_us": t}),
}


@pytest.mark.parametrize("name", RULES)
@pytest.mark.parametrize("seed", range(3))
def test_a_bucket_is_its_keys_one_by_one(name, seed):
    rule, fields, schema, make = RULES[name]
    r, bucket, single = random.Random(seed), State(), {f"k{k}": State() for k in range(12)}
    each, both = timed.alone(rule, fields, schema), timed.together(rule, ["event_id"], fields, schema)
    now, some = 1000, 0
    for _ in range(60):
        fresh = {k: [make(r, now * 1000 + r.randrange(-5, 12) * M // 2) for _ in range(r.randrange(1, 3))] for k in r.sample(sorted(single), r.choice([0, 0, 1, 4]))}
        want = [x for k, s in single.items() for x in s.call(each, (k,), fresh.get(k, []), now)]
        got = bucket.call(both, (7,), [{"event_id": k, **x} for k, own in fresh.items() for x in own], now)
        text = lambda found: sorted(str([None if v != v else v for v in x]) for x in found)
        assert text(got) == text(want)
        some, now = some + len(got), now + r.choice([0, 1, 30_000, 400_000, 3_000_000])
    assert some > 20 and (bucket.value is None or zlib.decompress(bucket.value[0]))


def test_a_fold_that_keeps_its_rounds_is_fitted_once(spark, monkeypatch):
    """Twenty rounds are grown in one go, and the best fold's model is not grown again."""
    r = random.Random(1)
    data = [(f"s{k % 6}", f"1998-01-{1 + k // 6:02}", r.choice("ab"), "x", float(k % 7), float(3 * (k % 7) + r.random())) for k in range(120)]
    df = spark.createDataFrame(data, "shelf_id string, feature_date string, item_category string, item_subcategory string, level double, batches_to_order double")
    df = df.withColumn("feature_date", F.col("feature_date").cast("date"))
    fitted, grower = [], ml.trees
    monkeypatch.setattr(ml, "trees", lambda rounds, *a: fitted.append(rounds) or grower(rounds, *a))
    got = ml.train(df, k=2, max_iter=4, max_depth=2, patience=2)
    kept = next(f for f in got.folds if f.fold == got.fold)
    assert kept.rounds == 4 and fitted == [4, 4] and got.model.stages[-1].getNumTrees == 4


def scanned(spark, n=600):
    r = random.Random(3)
    data = [(None if k % 3 == 0 else f"k{r.randrange(40)}", k, r.randrange(10), r.choice([None, f"v{k}"])) for k in range(n)]
    df = spark.createDataFrame(data, "k string, o int, v int, x string").repartition(5)
    return ordered.ordered_scan(df, ["k"], ["o"], sums={"s": "v"}, carry_on={"l": "x"}, look_ahead={"a": "x"})


def test_keys_of_usual_size_are_dealt_once(spark):
    """One shuffle by key, and no join with borders of slices."""
    text = plan(scanned(spark))
    assert len(re.findall(r"Exchange", text)) == 1 and "Join" not in text and "Scan ExistingRDD" in text


def test_large_keys_are_sliced_and_tasks_stay_small(spark, monkeypatch):
    want = sorted(map(str, scanned(spark).collect()))
    for limit in (100, 7):  # the null key only; most keys
        monkeypatch.setattr(ordered, "ROWS_PER_TASK", limit)
        got = scanned(spark)
        assert sorted(map(str, got.collect())) == want and "_slice" in plan(got)
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 250)
    few = spark.range(2000).selectExpr("id % 50 AS k", "id AS o", "1 AS v")
    assert "hashpartitioning(k" in (text := plan(ordered.ordered_scan(few, ["k"], ["o"], sums={"s": "v"}))) and "REPARTITION_BY_NUM" in text
