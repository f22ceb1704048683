"""Event-time windowed counts, for batch and streaming inputs.

Tumbling windows group directly by ``window(ts, length)``. Sliding windows
are built from tumbling panes of one slide: records are counted once per pane
and only the (small) pane counts are copied into the ``length / slide``
windows that cover them, instead of copying every record as a direct sliding
``window(ts, length, slide)`` aggregate does. Windows align to the epoch, as
Spark's ``window`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import COUNT, Metric
from .panes import WINDOW_END, WINDOW_START

_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
          "hours": 3600, "day": 86400, "days": 86400, "week": 604800, "weeks": 604800}


def duration_seconds(text: str) -> int:
    """'7 days' → 604800. Fixed-length units only (no months)."""
    num, unit = text.split()
    if unit.lower() not in _UNITS:
        raise ValueError(f"unsupported duration unit in {text!r}")
    return int(num) * _UNITS[unit.lower()]


def tumbling_counts(records: DataFrame, metric: Metric, ts: str, length: str,
                    watermark: str | None = None) -> DataFrame:
    src = records.withWatermark(ts, watermark) if watermark else records
    w = F.window(ts, length)
    return (src.where(metric.predicate())
            .groupBy(w.alias("w"), *metric.keys)
            .agg(F.count(F.lit(1)).alias(COUNT))
            .select(F.col("w.start").alias(WINDOW_START), F.col("w.end").alias(WINDOW_END),
                    *metric.keys, COUNT))


def sliding_counts(records: DataFrame, metric: Metric, ts: str, length: str,
                   slide: str) -> DataFrame:
    """Counts per sliding window (batch); ``length`` must be a multiple of ``slide``."""
    ln, sl = duration_seconds(length), duration_seconds(slide)
    if ln % sl:
        raise ValueError("window length must be a multiple of the slide")
    k = ln // sl
    panes = tumbling_counts(records, metric, ts, slide)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(sl))
    expanded = (panes.select(WINDOW_START, *metric.keys, COUNT,
                             F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_i"))
                .select((F.col(WINDOW_START) + step * F.col("_i")).alias(WINDOW_END),
                        *metric.keys, COUNT))
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ln))
    return (expanded.groupBy(WINDOW_END, *metric.keys)
            .agg(F.sum(COUNT).cast("bigint").alias(COUNT))
            .select((F.col(WINDOW_END) - span).alias(WINDOW_START), WINDOW_END,
                    *metric.keys, COUNT))
