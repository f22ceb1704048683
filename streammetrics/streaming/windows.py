"""Single-query Structured Streaming forms of the metrics.

These keep their state in Spark's state store instead of tables:

* ``arrival_window_counts`` — windows by arrival time: each record is stamped
  with its micro-batch time and counted in ``window(arrival, length, slide)``;
  with a watermark, append mode emits every window once, when it closes;
* ``event_time_window_counts`` — the same on a timestamp carried by the record,
  with a watermark bounding lateness and state;
* ``running_totals`` — ``groupBy(keys).count()`` over the whole stream, for
  complete or update output mode.

Sliding windows are sums of slide counts, two stateful steps, which a streaming query
runs in append mode only; the length must be a multiple of the slide.

Ranking (top-k, top-k per group) is not allowed on a streaming plan; apply
``metric.finish`` to the sink's table, or use the ``foreachBatch`` job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lines import parse_lines
from ..operators.metrics import COUNT, Metric
from ..operators.panes import WINDOW_END, WINDOW_START

ARRIVAL = "arrival"


def _windowed(records: DataFrame, metric: Metric, ts: str, length: str, slide: str | None,
              watermark: str) -> DataFrame:
    counts = (records.withWatermark(ts, watermark)
              .where(metric.predicate())
              .groupBy(F.window(ts, slide or length).alias("w"), *metric.keys)
              .agg(F.count(F.lit(1)).alias(COUNT)))
    if slide:
        # Each slide is counted once; only its counts are copied into the windows that cover it.
        counts = (counts.groupBy(F.window("w", length, slide).alias("v"), *metric.keys)
                  .agg(F.sum(COUNT).cast("bigint").alias(COUNT)).withColumnRenamed("v", "w"))
    return counts.select(F.col("w.start").alias(WINDOW_START), F.col("w.end").alias(WINDOW_END),
                         *metric.keys, COUNT)


def arrival_window_counts(lines: DataFrame, metric: Metric, length: str, slide: str | None = None,
                          watermark: str = "0 seconds", mode: str = "DROPMALFORMED") -> DataFrame:
    recs = parse_lines(lines, mode=mode).withColumn(ARRIVAL, F.current_timestamp())
    return _windowed(recs, metric, ARRIVAL, length, slide, watermark)


def event_time_window_counts(records: DataFrame, metric: Metric, ts: str, length: str,
                             slide: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    return _windowed(records, metric, ts, length, slide, watermark)


def running_totals(records: DataFrame, metric: Metric) -> DataFrame:
    """Totals per key over everything seen; output mode complete or update."""
    return metric.partial(records)
