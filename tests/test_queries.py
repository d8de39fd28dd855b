"""Every catalogued query against its expected SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry_points
from clipledger.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
)


@pytest.fixture(scope="module")
def expected():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, expected, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    difference = compare(result, expected, entry_points.oracle_sql()[name])
    assert difference is None, difference


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0
    assert "collected_comments" in result.columns
