"""Panes: slide-sized partial counts that merge into windows and running totals.

A pane holds one slide's worth of records. Windows of ``size`` slides and
running totals are both sums of pane partials, so every record is counted
once no matter how many windows overlap it, and neither needs the raw records
again. All work happens on aggregated rows: (#panes × #keys), not #records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import COUNT, Metric

PANE = "pane"
WINDOW_START = "window_start"
WINDOW_END = "window_end"
RUNNING = "running_count"


def month_pane(ts: Column) -> Column:
    """Monthly pane of a timestamp, as a date (first day of the month)."""
    return F.trunc(ts, "month")


def pane_partials(records: DataFrame, metric: Metric, pane: Column) -> DataFrame:
    """(pane, keys…, count) — one partial per pane, computed in one aggregate."""
    return metric.partial(records.withColumn(PANE, pane), extra_keys=[PANE])


def running_totals(partials: DataFrame, metric: Metric) -> DataFrame:
    """Running total per key over panes in time order.

    Emits one row per (pane, key) where the key has records in that pane: the
    pane's own count and the total over all panes up to and including it. The
    global table as of pane t is, per key, the latest row with pane ≤ t.
    """
    w = (Window.partitionBy(*metric.keys).orderBy(PANE)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return partials.select(PANE, *metric.keys, F.col(COUNT),
                           F.sum(COUNT).over(w).cast("bigint").alias(RUNNING))


def monthly_windows(partials: DataFrame, metric: Metric, size: int) -> DataFrame:
    """Sliding windows of ``size`` monthly panes, sliding by one pane.

    Each pane partial is copied into the ``size`` windows that cover it, then the
    copies are summed per window and key. Windows are [window_start, window_end).
    """
    if size < 1:
        raise ValueError("window size must be at least one pane")
    expanded = (partials.select(PANE, *metric.keys, COUNT,
                                F.explode(F.sequence(F.lit(1), F.lit(size))).alias("_i"))
                .select(F.add_months(F.col(PANE), F.col("_i")).alias(WINDOW_END),
                        *metric.keys, COUNT))
    return (expanded.groupBy(WINDOW_END, *metric.keys)
            .agg(F.sum(COUNT).cast("bigint").alias(COUNT))
            .select(F.add_months(F.col(WINDOW_END), -size).alias(WINDOW_START),
                    WINDOW_END, *metric.keys, COUNT))
