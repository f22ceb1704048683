"""Named batch queries over the fixture tables, one per operator group.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables, lazy but for ``top_regions_from_files``, whose files are the point. ``streammetrics.streaming.queries`` adds the streaming ones.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import encode_lines, parse_lines
from ..functions.stamps import with_stamp
from ..session import delete, scratch_path
from ..sources.feed import write_feed
from ..sources.files import read_lines
from ..operators import eventtime, panes
from ..operators.enrich import enrich
from ..operators.metrics import (MEDALS_BY_YEAR, TOP_10_CITIES, TOP_10_COUNTRIES_PER_YEAR,
                                 top_regions_unmerged)
from ..schema import EVENT_COLUMNS
from .lines_fixture import variant_lines
from ..sources.tables import achievements, region_lookup, source_events

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values used by the checked queries.
SLIDING_PANES = 3                 # window of three monthly panes, sliding by one
EVENT_WINDOW = "7 days"
EVENT_SLIDE = "7 days"
EVENT_SLIDING_WINDOW = "14 days"
FIXED_STAMP = datetime(2020, 1, 1, 12, 0, 0)


def _records(spark: SparkSession, sf_dir: str, metric, with_ts: bool = False) -> DataFrame:
    return achievements(spark, sf_dir, with_ts=with_ts, columns=(*metric.keys, "medal"))


def _pane_partials(spark: SparkSession, sf_dir: str, metric) -> DataFrame:
    recs = _records(spark, sf_dir, metric, with_ts=True)
    return panes.pane_partials(recs, metric, panes.month_pane(F.col("ts")))


def medals_by_year_window(spark, sf_dir):
    return MEDALS_BY_YEAR.local(_records(spark, sf_dir, MEDALS_BY_YEAR))


def medals_by_year_global(spark, sf_dir):
    return MEDALS_BY_YEAR.global_result(_pane_partials(spark, sf_dir, MEDALS_BY_YEAR))


def cities_window(spark, sf_dir):
    return TOP_10_CITIES.local(_records(spark, sf_dir, TOP_10_CITIES))


def top_10_cities_global(spark, sf_dir):
    return TOP_10_CITIES.global_result(_pane_partials(spark, sf_dir, TOP_10_CITIES))


def gold_by_year_region(spark, sf_dir):
    return TOP_10_COUNTRIES_PER_YEAR.local(_records(spark, sf_dir, TOP_10_COUNTRIES_PER_YEAR))


def top_10_regions_per_year(spark, sf_dir):
    return TOP_10_COUNTRIES_PER_YEAR.global_result(
        _pane_partials(spark, sf_dir, TOP_10_COUNTRIES_PER_YEAR))


def top_10_regions_per_year_unmerged(spark, sf_dir):
    return top_regions_unmerged(_pane_partials(spark, sf_dir, TOP_10_COUNTRIES_PER_YEAR),
                                panes.PANE)


def enrich_left_join(spark, sf_dir):
    return enrich(source_events(spark, sf_dir), region_lookup(spark, sf_dir))


def lines_round_trip(spark, sf_dir):
    return parse_lines(encode_lines(achievements(spark, sf_dir), EVENT_COLUMNS), mode="FAILFAST")


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record table as message lines, malformed variants included (lazy)."""
    return variant_lines(achievements(spark, sf_dir, with_keys=True)).select("value", "orderkey")


def lines_malformed_dropped(spark, sf_dir):
    return parse_lines(message_lines(spark, sf_dir))


def medals_by_year_from_lines(spark, sf_dir):
    return MEDALS_BY_YEAR.local(parse_lines(message_lines(spark, sf_dir)))


def feed_sources(spark: SparkSession, sf_dir: str, base: str, chosen=None) -> tuple[str, str]:
    """Write the feed's two input files, events and regions, both with a header; returns their paths."""
    events = source_events(spark, sf_dir)
    if chosen is not None:
        events = events.where(chosen)
    events.write.option("header", "true").option("nullValue", "NA").option("escape", '"').csv(
        f"{base}/events")
    region_lookup(spark, sf_dir).write.option("header", "true").option("nullValue", "").csv(
        f"{base}/regions")
    return f"{base}/events", f"{base}/regions"


def top_regions_from_files(spark, sf_dir):
    """The feed's path: both files are read as plain strings, left-joined on the country
    code and written as lines with nulls as empty fields, header line first; the lines are
    read and counted. Only the counts stay, the copies are deleted."""
    base = scratch_path(spark, "feed")
    out = write_feed(spark, *feed_sources(spark, sf_dir, base), f"{base}/lines", header=True)
    records = parse_lines(read_lines(spark, out, header=",".join(EVENT_COLUMNS)))
    counts = f"{scratch_path(spark, 'feed-counts')}"
    TOP_10_COUNTRIES_PER_YEAR.partial(records).write.parquet(counts)
    delete(spark, base)
    return TOP_10_COUNTRIES_PER_YEAR.global_result(spark.read.parquet(counts))


def running_totals_by_pane(spark, sf_dir):
    return panes.running_totals(_pane_partials(spark, sf_dir, MEDALS_BY_YEAR), MEDALS_BY_YEAR)


def sliding_pane_window(spark, sf_dir):
    return panes.monthly_windows(_pane_partials(spark, sf_dir, MEDALS_BY_YEAR),
                                 MEDALS_BY_YEAR, SLIDING_PANES)


def event_time_tumbling(spark, sf_dir):
    return eventtime.tumbling_counts(_records(spark, sf_dir, MEDALS_BY_YEAR, with_ts=True),
                                     MEDALS_BY_YEAR, "ts", EVENT_WINDOW)


def event_time_sliding(spark, sf_dir):
    return eventtime.sliding_counts(_records(spark, sf_dir, MEDALS_BY_YEAR, with_ts=True),
                                    MEDALS_BY_YEAR, "ts", EVENT_SLIDING_WINDOW, EVENT_SLIDE)


def stamped_output(spark, sf_dir):
    return with_stamp(MEDALS_BY_YEAR.local(_records(spark, sf_dir, MEDALS_BY_YEAR)), FIXED_STAMP)


BATCH_QUERIES: dict[str, Query] = {
    "medals_by_year_window": medals_by_year_window,
    "medals_by_year_global": medals_by_year_global,
    "cities_window": cities_window,
    "top_10_cities_global": top_10_cities_global,
    "gold_by_year_region": gold_by_year_region,
    "top_10_regions_per_year": top_10_regions_per_year,
    "top_10_regions_per_year_unmerged": top_10_regions_per_year_unmerged,
    "enrich_left_join": enrich_left_join,
    "lines_round_trip": lines_round_trip,
    "lines_malformed_dropped": lines_malformed_dropped,
    "medals_by_year_from_lines": medals_by_year_from_lines,
    "top_regions_from_files": top_regions_from_files,
    "running_totals_by_pane": running_totals_by_pane,
    "sliding_pane_window": sliding_pane_window,
    "event_time_tumbling": event_time_tumbling,
    "event_time_sliding": event_time_sliding,
    "stamped_output": stamped_output,
}
