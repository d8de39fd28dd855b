"""Shapes of the physical plans."""

import pytest

import __spark_entry__ as entry_points
from clipledger.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["bounded_take", "upsert_comments"])
def test_row_bounds_apply_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, SF_DIR))


def test_items_are_read_once(spark):
    """The id test sits in the explode; a filter would be pushed down and read items twice."""
    plan = plan_of(QUERIES["parse_video"](spark, SF_DIR))
    assert plan.count("parseJson") == 1 and "- Filter" not in plan


def test_scans_are_pruned(spark):
    plan = plan_of(entry_points.entry(spark))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    lines = [line for line in scans if "lineitem" in line]
    assert lines and not any("l_tax" in line or "l_extendedprice" in line for line in lines)
