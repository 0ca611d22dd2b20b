"""Regression guards on the physical plans of the registered queries (see PLANS.md)."""

import re

import pytest

from tests.conftest import SF_SMALL
from tidemark.plans.catalog import QUERIES

BY_NAME = {q.name: q for q in QUERIES}


def plan_of(spark, name):
    return BY_NAME[name].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["latest_n_per_series", "ma_per_series", "wma_per_series", "wma_flat",
                                  "summary_per_series", "ewma_limits_per_series", "model_dispatch",
                                  "transpose"])
def test_per_series_queries_limit_before_one_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["latest_n", "ma_global", "wma_global", "record_wma", "record_ma"])
def test_global_top_n_is_take_ordered(spark, name):
    plan = plan_of(spark, name)
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["ma_multi_metric", "wma_multi_metric", "summary_long", "ewma_limits"])
def test_newest_orders_are_selected_before_the_aggregation(spark, name):
    plan = plan_of(spark, name)
    assert "BroadcastExchange" not in plan and "Join" not in plan
    filters = [x for x in plan.splitlines() if "DataFilters: [((l_orderkey" in x]
    assert filters and all(">= Subquery" in x for x in filters)  # the n-th key filters the scan
    assert "MapInArrow" in plan


@pytest.mark.parametrize("name", ["record_wma", "record_ma"])
def test_every_message_is_built_before_the_newest_are_taken(spark, name):
    below = plan_of(spark, name).split("TakeOrderedAndProject")[-1]
    assert "Aggregate(keys=[l_orderkey" in below or "Aggregate(key=[l_orderkey" in below
    assert "Subquery" not in below and "MapInArrow" not in below


def test_large_latest_n_keeps_the_per_task_limit(spark):
    from tidemark.operators.recent import latest_n
    from tidemark.sources.tables import table
    df = latest_n(table(spark, SF_SMALL, "events"), 5000, "event_id", "user_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_no_row_at_a_time_python_anywhere(spark):
    for q in QUERIES:
        plan = q.build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan, q.name


@pytest.mark.parametrize("name", ["sliding_count", "sliding_avg"])
def test_sliding_windows_aggregate_panes_first(spark, name):
    plan = plan_of(spark, name)
    assert "Expand" not in plan.split("Exchange")[-1]   # no raw-row expansion below the first shuffle


def test_decoding_is_generated_code(spark):
    plan = BY_NAME["decode_vector"].build(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "transform(" not in plan and "exists(" not in plan
    physical = BY_NAME["decode_vector"].build(spark, SF_SMALL)
    physical.collect()
    lines = physical._jdf.queryExecution().executedPlan().toString().splitlines()
    steps = [x for x in lines if re.search(r"\b(Project|Filter) [\[(]", x)]
    assert steps and all("*(" in x for x in steps)


def test_messages_are_decoded_once(spark):
    plan = plan_of(spark, "decode_vector")
    assert plan.count("split(") == 1 and plan.count("concat_ws(") == 1


@pytest.mark.parametrize("name", ["window_latest_n_default", "sliding_limits", "sliding_summary"])
def test_windows_from_panes_read_once_and_stay_in_the_jvm(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Python" not in plan
