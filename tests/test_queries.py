"""Every registered query against its SQL check on the smallest test tables."""
import re

import pytest
from compare import check, duck

import __spark_entry__ as entry
from stockwright import suite

FOLDER = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in entry.queries().items() if n in suite.QUERIES}
ORACLES = suite.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def no_pairing_and_no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name), no_pairing_and_no_python) == []


def test_checks_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"model_predictions"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
