"""Every registered query agrees with its DuckDB statement (sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle_check import compare
from streammetrics.plans.queries import BATCH_QUERIES
from streammetrics.streaming.queries import STREAM_QUERIES

NAMES = sorted({**BATCH_QUERIES, **STREAM_QUERIES})


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    problems, n, _ = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert not problems, problems
    assert n > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "region", "count", "region_rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["event_time_sliding", "sliding_pane_window", "stamped_output",
                                  "running_totals_by_pane"])
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        problems, _, _ = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert not problems, problems
