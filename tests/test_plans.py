"""Shape of the physical plans."""
import re

import pytest
from helpers import day
from pyspark.sql import functions as F

from stockwright.plans import features as X, inventory as inv
from stockwright.suite.fixtures import Inputs

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+)\(?([^,)]*)", text)


def test_state_adds_up_before_the_shuffle(inputs):
    text = plan(inv.shelf_deltas(inputs["shelf_events"]))
    assert "partial_sum" in text and len(exchanges(text)) == 1


def test_panel_shuffles_once_after_its_input(inputs):
    raw = inputs.spark.createDataFrame(
        [("S1", None, 1, 0, 0, 0, 0.0)], "shelf_id string, feature_date date, sales_qty int, stockout_events int, is_shelf_alert int, is_warehouse_alert int, discount double")
    assert len(exchanges(plan(X.panel_features(raw)))) == 1


def test_forward_sum_is_a_window(inputs):
    text = plan(inputs["raw_panel"].withColumn("y", X.sales_next_7d()))
    assert "Window" in text and "Join" not in text


def test_scan_reads_needed_columns_only(inputs):
    text = plan(inv.wh_deltas(inputs["wh_events"]))
    assert "l_extendedprice" not in text and "l_tax" not in text


def test_rollups_read_one_pass(inputs):
    text = plan(X.sales_rollups(inputs["raw_panel"], day()))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_allocation_scans_written_slices(inputs):
    """Ordered rows come from range-partitioned slices; nothing is paired."""
    from stockwright.suite import QUERIES

    text = plan(QUERIES["fifo_allocation"](inputs))
    assert "Scan ExistingRDD" in text and not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
