"""Plan properties that the scale design relies on (static plans, AQE off)."""

import re

import pytest

import __spark_entry__ as E
from tidewater.session import conf_override

SF = "/root/testdata/sf0.01"


def _plan(spark, name):
    with conf_override(spark, {"spark.sql.adaptive.enabled": "false"}):
        return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan):
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)", plan))


def _read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@pytest.mark.parametrize("name,cols", [("word_count", "text:string"),
                                       ("group_sizes", "event_type:string"),
                                       ("json_parse", "event_id:bigint,props:string")])
def test_scans_read_only_needed_columns(spark, name, cols):
    assert _read_schemas(_plan(spark, name)) == [cols]


@pytest.mark.parametrize("name", ["word_count", "tumbling_sum", "latest_point_batch", "group_sizes",
                                  "pair_actions", "table_scan"])
def test_aggregations_shuffle_once_after_partial(spark, name):
    plan = _plan(spark, name)
    assert _exchanges(plan) == 1
    assert "partial_" in plan


def test_singleton_is_a_subquery_not_a_join(spark):
    plan = _plan(spark, "side_input")
    assert "Subquery" in plan and "Join" not in plan and "CartesianProduct" not in plan


def test_sessions_scan_events_twice_and_shuffle_data_once(spark):
    plan = _plan(spark, "session_latest")
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert _exchanges(plan) <= 5 and "SortAggregate" not in plan


def test_lead_scans_twice_without_sort_aggregates(spark):
    plan = _plan(spark, "lead_end")
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert "SortAggregate" not in plan and _exchanges(plan) == 3


def test_filter_pushed_below_ordering(spark):
    plan = _plan(spark, "rat_with_actions")
    assert plan.count("EqualTo(event_type,error)") == 2
    assert "EqualTo(event_type,signup)" in plan
