"""Physical plans: JVM-only work, pruned scans, partial aggregates, limited windows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from streammetrics.functions.lines import parse_lines
from streammetrics.operators.enrich import enrich
from streammetrics.sources.tables import region_lookup, source_events


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["medals_by_year_window", "top_10_regions_per_year",
                                  "top_10_cities_global", "event_time_sliding", "enrich_left_join"])
def test_no_python_in_plans(spark, name):
    p = plan(entry.queries()[name](spark, SMALL))
    assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_partial_and_final_aggregate(spark):
    p = plan(entry.queries()["medals_by_year_window"](spark, SMALL))
    assert "partial_count" in p


def test_topk_uses_take_ordered(spark):
    p = plan(entry.queries()["top_10_cities_global"](spark, SMALL))
    assert "TakeOrderedAndProject" in p


def test_top_k_per_group_uses_window_group_limit(spark):
    p = plan(entry.queries()["top_10_regions_per_year"](spark, SMALL))
    assert "WindowGroupLimit" in p


def test_scans_read_only_needed_columns(spark):
    df = entry.queries()["medals_by_year_window"](spark, SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read without price / tax / discount columns
    assert "l_extendedprice" not in p and "l_tax" not in p


def test_lookup_join_is_broadcast(spark):
    df = enrich(source_events(spark, SMALL), region_lookup(spark, SMALL))
    assert "BroadcastHashJoin" in plan(df) or "broadcast" in optimized(df).lower()


def test_parser_splits_each_line_once(spark):
    lines = spark.createDataFrame([("a",)], "value string")
    p = plan(parse_lines(lines))
    assert p.count("from_csv") == 1 and "Generate" in p
