"""Event-time windows of a stream, with a count of what comes too late.

Spark's own windowed aggregate drops rows behind the watermark without a trace. Here each
micro-batch is split by the watermark that held before it: a row is late if the slide (pane) it
belongs to had ended by then. Late rows are counted by pane and key in a side table; all others join
the open panes. The watermark then moves to the greatest event time less the allowed delay, and
every window that it has passed is written, once, from the merged panes. So windows plus open panes plus late
rows are all rows, whatever their order.

Everything is keyed by ``batch_id``: a batch that runs again starts from the state before it and replaces only its own
partitions. The state is the partials of the panes that a window to come still needs, (open panes × keys) rows,
rewritten once a batch; the watermark is one number beside it. Records are aggregated once and never kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import Metric
from ..operators.panes import WINDOW_END, WINDOW_START
from ..session import delete, exists, list_partitions
from ..sinks.folding import fold_batches, read_folded
from ..sinks.writers import BATCH_ID, write_batch_partition

PANE = "pane"                 # start of a pane, microseconds from the epoch
LATE = "late"
ROWS = "rows"
_WATERMARK = T.StructType([T.StructField("watermark", T.LongType())])


@dataclass(frozen=True)
class EventJobConfig:
    metric: Metric
    ts: str                       # timestamp column of the records
    window_seconds: int
    slide_seconds: int
    delay_seconds: int            # how far behind the greatest event time a pane still takes rows
    checkpoint_dir: str
    output_dir: str
    available_now: bool = False
    fold_tables: int = 200

    def __post_init__(self):
        if self.slide_seconds <= 0 or self.window_seconds % self.slide_seconds or self.window_seconds <= 0:
            raise ValueError("window length must be a positive multiple of the slide")
        if self.delay_seconds < 0:
            raise ValueError("the delay must be >= 0")


class EventTimeJob:
    """Windows by event time over a stream of typed records, with ``foreachBatch``."""

    def __init__(self, spark: SparkSession, cfg: EventJobConfig):
        self.spark, self.cfg = spark, cfg
        self.slide = cfg.slide_seconds * 1_000_000
        self.length = cfg.window_seconds * 1_000_000

    def _p(self, *parts: str) -> str:
        return "/".join([self.cfg.output_dir.rstrip("/"), *parts])

    def _before(self, name: str, batch_id: int) -> int | None:
        older = [b for b in list_partitions(self.spark, self._p("state", name), BATCH_ID) if b < batch_id]
        return older[-1] if older else None

    def _state(self, name: str, batch_id: int, schema: T.StructType) -> DataFrame:
        path = f"{self._p('state', name)}/{BATCH_ID}={batch_id}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _watermark(self, batch_id: int) -> int | None:
        before = self._before("watermark", batch_id)
        row = None if before is None else self._state("watermark", before, _WATERMARK).first()
        return None if row is None else row["watermark"]

    def _windows(self, panes: DataFrame, after: int | None, upto: int) -> DataFrame:
        """Merged panes of the windows that end after ``after`` and by ``upto``."""
        metric, n = self.cfg.metric, self.length // self.slide
        ends = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_i")
        copies = panes.select("*", ends).withColumn(WINDOW_END, F.col(PANE) + F.col("_i") * self.slide)
        copies = copies.where(F.col(WINDOW_END) <= upto)
        if after is not None:
            copies = copies.where(F.col(WINDOW_END) > after)
        return metric.results(metric.merge(copies, [WINDOW_END]))

    def process_batch(self, records: DataFrame, batch_id: int) -> None:
        cfg, metric = self.cfg, self.cfg.metric
        before = self._watermark(batch_id)
        us = F.unix_micros(F.col(cfg.ts).cast("timestamp"))
        pane = (F.floor(us / self.slide) * self.slide).cast("long")
        late = F.col(PANE).isNull() | ((F.col(PANE) + self.slide <= before) if before is not None else F.lit(False))
        # One aggregate: partial states by pane and key, late or not, and the greatest event time of each.
        kept = records.where(metric.predicate()).withColumn(PANE, pane).withColumn("_us", us)
        partial = kept.groupBy(PANE, *metric.keys).agg(
            *[s.partial(F.lit(True)).alias(s.name) for s in metric.states],
            F.count(F.lit(1)).alias(ROWS), F.max("_us").alias("_us")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n, newest = partial.agg(F.sum(ROWS), F.max("_us")).first()
            if not n:
                return
            moved = before if newest is None else max(newest - cfg.delay_seconds * 1_000_000,
                                                      before if before is not None else newest - cfg.delay_seconds * 1_000_000)
            write_batch_partition(partial.where(late).select(PANE, *metric.keys, ROWS), self._p("tables", LATE), batch_id)
            panes = partial.where(~late).drop(ROWS, "_us")
            last = self._before("panes", batch_id)
            if last is not None:
                panes = panes.unionByName(self._state("panes", last, panes.schema))
            panes = metric.merge(panes, [PANE]).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if moved is not None:
                    write_batch_partition(self._windows(panes, before, moved), self._p("tables", metric.id), batch_id)
                    open_ = panes.where(F.col(PANE) + self.length > moved)
                else:
                    open_ = panes
                write_batch_partition(open_, self._p("state", "panes"), batch_id)
                mark = self.spark.createDataFrame([(moved,)], _WATERMARK)
                write_batch_partition(mark.coalesce(1), self._p("state", "watermark"), batch_id)
            finally:
                panes.unpersist()
        finally:
            partial.unpersist()
        for name in ("panes", "watermark"):      # what a rerun of this batch would start from stays
            first = self._before(name, batch_id)
            for b in list_partitions(self.spark, self._p("state", name), BATCH_ID):
                if first is not None and b < first:
                    delete(self.spark, f"{self._p('state', name)}/{BATCH_ID}={b}")
        for name in (LATE, metric.id):
            fold_batches(self.spark, self._p("tables", name), batch_id, cfg.fold_tables)

    def start(self, records: DataFrame) -> StreamingQuery:
        w = records.writeStream.foreachBatch(self.process_batch).option("checkpointLocation", self.cfg.checkpoint_dir)
        w = w.trigger(availableNow=True) if self.cfg.available_now else w.trigger(
            processingTime=f"{self.cfg.slide_seconds} seconds")
        return w.start()

    # --- results ---------------------------------------------------------------
    def _key_fields(self, records: DataFrame) -> list[T.StructField]:
        return [T.StructField(k, records.schema[k].dataType) for k in self.cfg.metric.keys]

    def _bounds(self) -> list[Column]:
        return [F.timestamp_micros(F.col(WINDOW_END) - self.length).alias(WINDOW_START),
                F.timestamp_micros(F.col(WINDOW_END)).alias(WINDOW_END)]

    def read_windows(self, records: DataFrame) -> DataFrame:
        """(window_start, window_end, keys…, results…) of the windows that have closed. ``records`` gives the columns' types."""
        metric = self.cfg.metric
        empty = self.spark.createDataFrame([], records.schema).withColumn(WINDOW_END, F.lit(0).cast("long"))
        schema = metric.results(metric.merge(metric.partial(empty, [WINDOW_END]), [WINDOW_END])).schema
        rows = read_folded(self.spark, self._p("tables", metric.id), schema=schema)
        return rows.select(*self._bounds(), *[c for c in schema.fieldNames() if c != WINDOW_END])

    def read_open(self, records: DataFrame) -> DataFrame:
        """The windows that rows so far belong to and that the watermark has not passed, as they stand."""
        metric = self.cfg.metric
        empty = self.spark.createDataFrame([], records.schema).withColumn(PANE, F.lit(0).cast("long"))
        schema = metric.merge(metric.partial(empty, [PANE]), [PANE]).schema
        have = list_partitions(self.spark, self._p("state", "panes"), BATCH_ID)
        if not have:
            panes = self.spark.createDataFrame([], schema)
        else:
            panes = self._state("panes", have[-1], schema)
        rows = self._windows(panes, self._watermark(have[-1] + 1) if have else None, (1 << 63) - 1)
        return rows.select(*self._bounds(), *[c for c in rows.columns if c != WINDOW_END])

    def read_late(self, records: DataFrame) -> DataFrame:
        """(pane, keys…, rows): late rows by the pane they belong to; the pane of a row without a time is null."""
        schema = T.StructType([T.StructField(PANE, T.LongType()), *self._key_fields(records), T.StructField(ROWS, T.LongType())])
        rows = read_folded(self.spark, self._p("tables", LATE), schema=schema)
        return rows.groupBy(F.timestamp_micros(PANE).alias(PANE), *self.cfg.metric.keys).agg(F.sum(ROWS).alias(ROWS))


__all__ = ["EventJobConfig", "EventTimeJob"]
