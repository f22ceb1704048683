"""The continuous metrics job: lines stream → per-window and running results.

Each micro-batch is one slide of arrivals (a *pane*). The batch is parsed
once and one grouping-sets aggregate gives every metric's partial states (plus
line and record counts). From these partials the batch derives, for all metrics
at once,

* the window result: the merged pane partials of the last window/slide slides,
  by slide number (the batch's start time over the slide length) — each record taken
  once per window it falls in (a tumbling window is the batch itself, so no pane table
  is kept);
* the running totals: a base of totals and a log of the batches' partials since — each record
  taken once overall. The log is folded into a new base every ``fold_totals`` batches, so the state
  that a slide writes follows the batch's keys, not all keys;

and writes, per metric, a CSV dump and an append table (per window) and a
versioned global table. With windows longer than a slide, a clock stream beside the lines makes a batch
of every slide, so a slide without lines whose window still holds a pane gives its window too, also
after the last line. Everything is keyed by ``batch_id``: a batch that runs again after a
failure reuses its stamp and overwrites only its own partitions, so results
stay exact. The append tables' closed batches are folded into few files (``sinks.folding``; read them with
``read_windows``). State lives in tables under the output folder, never in the
driver, and the stable checkpoint lets a restarted job continue.

Usage: ``python -m streammetrics.streaming.job WINDOW_S SLIDE_S MINUTES CHECKPOINT_DIR``
plus ``--source``/``--output`` options (see ``main``).
"""

from __future__ import annotations

import argparse
import sys
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.lines import OK, flag_lines
from ..functions.stamps import STAMP, batch_folder, stamp_folder, stamp_literal
from ..operators.metrics import (COUNT, METRICS, Metric, by_id, combined_partials, merge_combined, nonzero,
                                 row_counts, split_partial)
from ..session import build_session, delete, exists, list_partitions
from ..sinks.folding import fold_batches, read_folded
from ..sinks.writers import BATCH_ID, append_table, read_latest, replace_table, write_batch_partition, write_dump
from ..schema import EVENT_SCHEMA
from ..sources.files import clock_ticks, read_stream

BATCHES = "_batches"          # per-batch line and record counts
BATCHES_SCHEMA = T.StructType([T.StructField(STAMP, T.TimestampType()), T.StructField("lines", T.LongType()),
                               T.StructField("records", T.LongType())])
# Panes in the window with their slots; the row without a pane is the last slot whose window is out.
RECENT_SCHEMA = T.StructType([T.StructField("pane", T.LongType()), T.StructField("slot", T.LongType())])


def _micros(t: datetime) -> int:
    return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _from_micros(us: int) -> datetime:
    return datetime.fromtimestamp(us / 1_000_000, tz=timezone.utc)


@dataclass(frozen=True)
class JobConfig:
    window_seconds: int
    slide_seconds: int
    minutes: int                      # 0 = run until stopped
    checkpoint_dir: str
    output_dir: str
    source_format: str = "text"
    source_path: str | None = None
    source_options: Mapping[str, str] = field(default_factory=dict)
    table_format: str = "parquet"
    table_options: Mapping[str, str] = field(default_factory=dict)
    table_prefix: str | None = None   # catalog tables <prefix><metric>[_global] instead of files under output_dir
    source_schema: str | T.StructType | None = None   # of message files that need one (parquet, json, …)
    payload: str = "value"            # source column that holds the message
    parse_mode: str = "DROPMALFORMED"
    partitions: int | None = None     # cap on batch input and shuffle partitions
    available_now: bool = False       # process what is there, then stop (tests, backfills)
    keep_versions: int = 3            # versions of each global table kept for readers
    fold_totals: int = 16             # batches whose partials are kept apart before they go into the base of totals
    fold_tables: int = 200            # closed batches of an append table that are folded together
    metrics: tuple[Metric, ...] = METRICS

    def __post_init__(self):
        if self.window_seconds <= 0 or self.slide_seconds <= 0:
            raise ValueError("window and slide must be positive")
        if self.window_seconds % self.slide_seconds:
            raise ValueError("window length must be a multiple of the slide")
        if self.minutes < 0:
            raise ValueError("minutes must be >= 0")
        if self.keep_versions < 1:
            raise ValueError("keep_versions must be >= 1")
        if self.fold_totals < 1 or self.fold_tables < 1:
            raise ValueError("fold_totals and fold_tables must be >= 1")

    @property
    def tumbling(self) -> bool:
        return self.window_seconds == self.slide_seconds


class MetricsJob:
    """Runs the metrics over a lines stream with ``foreachBatch``."""

    def __init__(self, spark: SparkSession, cfg: JobConfig,
                 clock: Callable[[int], datetime] | None = None):
        self.spark = spark
        self.cfg = cfg
        # Start time of a batch; tests pass a simulated clock.
        self.clock = clock or (lambda _batch_id: datetime.now(timezone.utc))
        self._recent: dict[int, int] = {}           # batch id → slot, within one window
        self._out: int | None = None                # last slot whose window is out
        self._recovered = False

    # --- paths ----------------------------------------------------------------
    def _p(self, *parts: str) -> str:
        return "/".join([self.cfg.output_dir.rstrip("/"), *parts])

    # --- state tables ---------------------------------------------------------
    def _read_batches(self, path: str, ids, schema: T.StructType) -> DataFrame:
        """Rows of the given batch partitions only (no listing of the whole table)."""
        have = set(list_partitions(self.spark, path, BATCH_ID))
        paths = [f"{path}/{BATCH_ID}={b}" for b in sorted(set(ids)) if b in have]
        if not paths:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).option("basePath", path).parquet(*paths)
        return df.select(*schema.fieldNames())

    def _recorded(self, batch_id: int) -> datetime | None:
        mine = f"{self._p('tables', BATCHES)}/{BATCH_ID}={batch_id}"
        if not exists(self.spark, mine):
            return None
        us = self.spark.read.parquet(mine).select(F.unix_micros(STAMP)).first()
        return None if us is None else _from_micros(us[0])

    def _stamp(self, batch_id: int, started: datetime, n_lines: int, n_records: int) -> datetime:
        """One stamp per batch, the time it began, recorded (with its line and record counts)
        before any output, so that a rerun of the batch reuses it."""
        before = self._recorded(batch_id)
        if before is not None:
            return before
        rec = self.spark.range(1).select(
            stamp_literal(started).alias(STAMP), F.lit(n_lines).cast("long").alias("lines"),
            F.lit(n_records).cast("long").alias("records"))
        write_batch_partition(rec, self._p("tables", BATCHES), batch_id)
        return started

    def _slot(self, stamp: datetime) -> int:
        """The slide a batch belongs to, counted from the epoch: jitter within a slide doesn't matter."""
        return _micros(stamp) // (self.cfg.slide_seconds * 1_000_000)

    def _recover(self, batch_id: int) -> None:
        """After a restart: the slots of the panes that the last batch still held in its window.
        They lie beside the totals, so no history is listed."""
        if self._recovered:
            return
        self._recovered = True
        path = self._p("state", "recent")
        before = [b for b in list_partitions(self.spark, path, BATCH_ID) if b < batch_id]
        if before:
            rows = self._read_batches(path, before[-1:], RECENT_SCHEMA).collect()  # one row per pane of a window
            self._recent = {r["pane"]: r["slot"] for r in rows if r["pane"] is not None}
            self._out = max(r["slot"] for r in rows)

    def _windows(self, batch_id: int, slot: int, lines: bool) -> tuple[list[tuple[int, list[int], bool]], dict[int, int], int]:
        """((slot, panes, whether it is the batch's own window) of each window due, panes then in the
        window, last slot out). Due are the windows of idle slides that still hold a pane, up to a batch without
        lines or before one with lines, and the latter's own. A window holds the panes of its last window/slide slots."""
        n = self.cfg.window_seconds // self.cfg.slide_seconds
        before = {b: s for b, s in self._recent.items() if b < batch_id}
        last = max(before.values(), default=None)
        out = self._out if last is None or self._out is not None and self._out >= last else last
        if out is not None:
            slot = max(slot, out)        # a clock set back doesn't reorder panes
        due = []
        if last is not None:
            for t in range(out + 1, min(slot if lines else slot + 1, last + n)):
                due.append((t, sorted(b for b, s in before.items() if t - n < s <= t), False))
        recent = {b: s for b, s in before.items() if s > slot - n} | ({batch_id: slot} if lines else {})
        if lines:
            due.append((slot, sorted(recent), True))
        return due, recent, slot

    def _remember(self, batch_id: int, recent: dict[int, int], out: int) -> None:
        rows = [*sorted(recent.items()), (None, out)]
        write_batch_partition(self.spark.createDataFrame(rows, RECENT_SCHEMA).coalesce(1), self._p("state", "recent"), batch_id)

    def _previous_totals(self, totals_path: str, batch_id: int) -> int | None:
        older = [b for b in list_partitions(self.spark, totals_path, BATCH_ID) if b < batch_id]
        return older[-1] if older else None

    def _drop_partitions(self, path: str, keep) -> None:
        for b in list_partitions(self.spark, path, BATCH_ID):
            if not keep(b):
                delete(self.spark, f"{path}/{BATCH_ID}={b}")

    # --- one micro-batch ------------------------------------------------------
    def process_batch(self, lines: DataFrame, batch_id: int) -> None:
        cfg = self.cfg
        started = self.clock(batch_id)     # before any work: run time doesn't move a batch to another slide
        lines = lines.where(F.col("value").isNotNull())       # a tick of the clock is no line
        if cfg.partitions:
            lines = lines.coalesce(cfg.partitions)
        # One pass over the batch: every line is split and typed once, and one
        # grouping-sets aggregate yields every metric's partial states plus the
        # line and record counts (malformed lines count as lines only). Only that
        # small result is cached.
        flagged = flag_lines(lines, mode=cfg.parse_mode)
        combined = combined_partials(flagged, cfg.metrics, valid=F.col(OK))
        combined = combined.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n_lines, n_records = row_counts(combined, cfg.metrics).first()
            if n_lines:            # raw lines: a window of malformed lines is not empty
                self._busy_slide(combined, batch_id, self._stamp(batch_id, started, n_lines, n_records))
            elif not cfg.tumbling:
                self._idle_slide(combined.schema, batch_id, started)
        finally:
            combined.unpersist()
        self._fold_tables(batch_id)

    def _fold_tables(self, batch_id: int) -> None:
        """Fold the closed batches of the append tables once there are enough of them."""
        cfg = self.cfg
        fold_batches(self.spark, self._p("tables", BATCHES), batch_id, cfg.fold_tables)
        if cfg.table_prefix is None and cfg.table_format in ("parquet", "orc"):
            for metric in cfg.metrics:
                fold_batches(self.spark, self._p("tables", metric.id), batch_id, cfg.fold_tables, cfg.table_format,
                             cfg.table_options)

    def _append(self, df: DataFrame, name: str, batch_id: int) -> None:
        cfg = self.cfg
        if cfg.table_prefix is None:
            write_batch_partition(df, self._p("tables", name), batch_id, cfg.table_format, cfg.table_options)
        else:
            append_table(df, cfg.table_prefix + name, batch_id, cfg.table_format, cfg.table_options)

    def _window_outputs(self, metric: Metric, batch_id: int, results: list[tuple[datetime, DataFrame]]) -> None:
        """A metric's dumps and stamped rows of the windows of one batch."""
        stamped = None
        for at, window in results:
            local = metric.results(split_partial(window, self.cfg.metrics, metric))
            order = metric.order()
            folder = f"{stamp_folder(at)}-{batch_folder(batch_id)}"   # unique per batch and window
            write_dump(local.orderBy(*order) if order else local, self._p("dumps", folder, metric.id))
            rows = local.withColumn(STAMP, stamp_literal(at))
            stamped = rows if stamped is None else stamped.unionByName(rows)
        self._append(stamped, metric.id, batch_id)

    def _window_results(self, windows: list[tuple[int, list[int], bool]], schema: T.StructType,
                        stamp: datetime) -> list[tuple[datetime, DataFrame]]:
        """Merged panes of each window; that of an idle slide is stamped with the time its slide began."""
        panes_path = self._p("state", "panes")
        return [(stamp if own else _from_micros(slot * self.cfg.slide_seconds * 1_000_000),
                 merge_combined(self._read_batches(panes_path, panes, schema), self.cfg.metrics))
                for slot, panes, own in windows]

    def _global_output(self, metric: Metric, totals: DataFrame, batch_id: int, stamp: datetime) -> None:
        cfg = self.cfg
        result = metric.finish(metric.results(split_partial(totals, cfg.metrics, metric))).withColumn(
            STAMP, stamp_literal(stamp))
        name = f"{metric.id}_global"
        if cfg.table_prefix is not None:
            replace_table(result, cfg.table_prefix + name, batch_id, cfg.keep_versions, cfg.table_format, cfg.table_options)
            return
        global_path = self._p("tables", name)
        write_batch_partition(result, global_path, batch_id, cfg.table_format, cfg.table_options)
        versions = list_partitions(self.spark, global_path, BATCH_ID)
        keep_from = versions[-cfg.keep_versions] if len(versions) >= cfg.keep_versions else -1
        self._drop_partitions(global_path, lambda b: b >= keep_from)

    def _idle_slide(self, schema: T.StructType, batch_id: int, started: datetime) -> None:
        """A batch without lines: the windows of the slides since the last batch that still hold a pane.
        The totals don't change. A rerun takes the recorded stamp, hence the same slides."""
        self._recover(batch_id)
        windows, recent, out = self._windows(batch_id, self._slot(self._recorded(batch_id) or started), False)
        if not windows:
            return
        stamp = self._stamp(batch_id, started, 0, 0)
        results = self._window_results(windows, schema, stamp)
        for metric in self.cfg.metrics:
            self._window_outputs(metric, batch_id, results)
        self._remember(batch_id, recent, out)
        self._recent, self._out = recent, out

    def _busy_slide(self, combined: DataFrame, batch_id: int, stamp: datetime) -> None:
        cfg, metrics = self.cfg, self.cfg.metrics
        panes_path, deltas_path, totals_path = (self._p("state", d) for d in ("panes", "deltas", "totals"))
        schema = combined.schema
        self._recover(batch_id)
        windows, recent, out = self._windows(batch_id, self._slot(stamp), True)
        mine = nonzero(combined, metrics)

        # 1. window = merged partials of the panes in the window. A tumbling
        #    window is this batch alone and needs no pane table.
        if cfg.tumbling:
            results = [(stamp, combined)]
        else:
            write_batch_partition(mine, panes_path, batch_id)
            results = self._window_results(windows, schema, stamp)

        # 2. per metric: window dumps + stamped append. These are independent small
        #    jobs; they run concurrently with each other and with step 3.
        kept = None
        with ThreadPoolExecutor(max_workers=2 * len(metrics)) as pool:
            def submit(f, *args):      # jobs of the pool belong to the stream's job group and end with it
                return pool.submit(inheritable_thread_target(self.spark)(f), *args)

            futures = [submit(self._window_outputs, m, batch_id, results) for m in metrics]

            # 3. running totals = base + partials since (one table each for all metrics), then
            #    each metric's global result (versioned). The first batch and every ``fold_totals``-th
            #    after a base write the next base.
            write_batch_partition(mine, deltas_path, batch_id)
            base = self._previous_totals(totals_path, batch_id)
            lo = base if base is not None else -1
            since = [b for b in list_partitions(self.spark, deltas_path, BATCH_ID) if lo < b <= batch_id]
            parts = self._read_batches(deltas_path, since, schema)
            if base is not None:
                parts = parts.unionByName(self._read_batches(totals_path, [base], schema))
            totals = merge_combined(parts, metrics)
            if base is None or len(since) >= cfg.fold_totals:
                write_batch_partition(totals, totals_path, batch_id)
                totals = self._read_batches(totals_path, [batch_id], schema)
            else:
                kept = totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
            if not cfg.tumbling:
                self._remember(batch_id, recent, out)
            try:
                futures += [submit(self._global_output, m, totals, batch_id, stamp) for m in metrics]
                for f in futures:
                    f.result()
            finally:
                if kept is not None:
                    kept.unpersist()

        # 4. retention: what is folded into the base and out of the window goes;
        #    the base and log that a rerun of this batch would start from stay.
        self._drop_partitions(totals_path, lambda b: base is None or b >= base)
        self._drop_partitions(deltas_path, lambda b: b > lo)
        if not cfg.tumbling:
            first = min(p for _, panes, _ in windows for p in panes)
            before = [b for b in list_partitions(self.spark, self._p("state", "recent"), BATCH_ID) if b < batch_id]
            self._drop_partitions(self._p("state", "recent"), lambda b: b >= (before[-1] if before else 0))
            self._drop_partitions(panes_path, lambda b: b >= first)
        self._recent, self._out = recent, out

    # --- running --------------------------------------------------------------
    def start(self) -> StreamingQuery:
        cfg = self.cfg
        lines = read_stream(self.spark, cfg.source_format, cfg.source_path, cfg.source_options, cfg.payload,
                            cfg.source_schema)
        if not cfg.tumbling:
            lines = lines.unionByName(clock_ticks(self.spark).select(F.lit(None).cast("string").alias("value")))
        w = (lines.writeStream.foreachBatch(self.process_batch)
             .option("checkpointLocation", cfg.checkpoint_dir))
        if cfg.available_now:
            w = w.trigger(availableNow=True)
        else:
            w = w.trigger(processingTime=f"{cfg.slide_seconds} seconds")
        key = "spark.sql.shuffle.partitions"
        before = self.spark.conf.get(key)
        try:        # a query keeps the settings it is started with
            if cfg.partitions:
                self.spark.conf.set(key, str(cfg.partitions))
            return w.start()
        finally:
            self.spark.conf.set(key, before)

    def run(self) -> None:
        q = self.start()
        try:
            if self.cfg.available_now or self.cfg.minutes == 0:
                q.awaitTermination()
            else:
                q.awaitTermination(self.cfg.minutes * 60)
        finally:
            q.stop()


def global_schema(spark: SparkSession, metric: Metric) -> T.StructType:
    """Columns of a metric's global table."""
    empty = spark.createDataFrame([], EVENT_SCHEMA)
    return T.StructType([*metric.global_result(metric.partial(empty)).schema.fields, T.StructField(STAMP, T.TimestampType())])


def window_schema(spark: SparkSession, metric: Metric) -> T.StructType:
    """Columns of a metric's append table, without the batch id."""
    empty = spark.createDataFrame([], EVENT_SCHEMA)
    return T.StructType([*metric.results(metric.partial(empty)).schema.fields, T.StructField(STAMP, T.TimestampType())])


def read_windows(spark: SparkSession, output_dir: str, metric: str | Metric, fmt: str = "parquet") -> DataFrame:
    """All window results of a metric (stamp and batch id included), folded or not; empty before the first."""
    if isinstance(metric, str):
        metric = by_id(metric)
    return read_folded(spark, f"{output_dir.rstrip('/')}/tables/{metric.id}", fmt, schema=window_schema(spark, metric))


def read_batches(spark: SparkSession, output_dir: str) -> DataFrame:
    """Stamp, lines, records and id of every batch that wrote results."""
    return read_folded(spark, f"{output_dir.rstrip('/')}/tables/{BATCHES}", schema=BATCHES_SCHEMA)


def read_global(spark: SparkSession, output_dir: str, metric: str | Metric,
                fmt: str = "parquet") -> DataFrame:
    """Newest global result of a metric (stamp column included); empty before the first record."""
    if isinstance(metric, str):
        metric = by_id(metric)   # a metric outside the registry is passed itself
    path = f"{output_dir.rstrip('/')}/tables/{metric.id}_global"
    return read_latest(spark, path, fmt, global_schema(spark, metric))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Continuous medal metrics over a lines stream.")
    ap.add_argument("window", type=int, help="window length in seconds")
    ap.add_argument("slide", type=int, help="slide interval in seconds")
    ap.add_argument("minutes", type=int, help="running time in minutes (0 = forever)")
    ap.add_argument("checkpoint", help="checkpoint folder (stable across restarts)")
    ap.add_argument("--output", required=True, help="folder for state, dumps and tables")
    ap.add_argument("--source-format", default="text")
    ap.add_argument("--source-path")
    ap.add_argument("--source-option", action="append", default=[], metavar="K=V")
    ap.add_argument("--payload", default="value", help="source column that holds the message")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--table-format", default="parquet")
    ap.add_argument("--table-option", action="append", default=[], metavar="K=V")
    ap.add_argument("--table-prefix", help="write catalog tables PREFIX<metric> and PREFIX<metric>_global")
    ap.add_argument("--keep-versions", type=int, default=3, help="versions kept of a global table")
    ap.add_argument("--fold-totals", type=int, default=16, help="batches between two bases of the totals")
    ap.add_argument("--fold-tables", type=int, default=200, help="closed batches folded together in an append table")
    ap.add_argument("--source-schema", help="DDL schema of message files that need one")
    ap.add_argument("--metric", action="append", default=[], metavar="ID", help="metrics by id (default: the three)")
    ap.add_argument("--partitions", type=int)
    ap.add_argument("--mode", default="DROPMALFORMED")
    ap.add_argument("--app-name", default="streammetrics")
    try:
        args = ap.parse_args(argv)
    except SystemExit as e:
        if e.code:
            print("ERROR: expected WINDOW SLIDE MINUTES CHECKPOINT_DIR", file=sys.stderr)
            return 1
        raise
    cfg = JobConfig(args.window, args.slide, args.minutes, args.checkpoint, args.output,
                    source_format=args.source_format, source_path=args.source_path,
                    source_options=dict(o.split("=", 1) for o in args.source_option),
                    table_format=args.table_format, table_prefix=args.table_prefix,
                    table_options=dict(o.split("=", 1) for o in args.table_option),
                    keep_versions=args.keep_versions, payload=args.payload, fold_totals=args.fold_totals,
                    fold_tables=args.fold_tables, source_schema=args.source_schema,
                    metrics=tuple(by_id(m) for m in args.metric) or METRICS,
                    available_now=args.available_now, parse_mode=args.mode, partitions=args.partitions)
    spark = build_session(app=args.app_name)
    MetricsJob(spark, cfg).run()
    return 0


if __name__ == "__main__":
    sys.exit(main())


__all__ = ["JobConfig", "MetricsJob", "read_batches", "read_global", "read_windows", "main"]
