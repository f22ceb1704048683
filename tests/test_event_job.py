"""Event-time windows with late rows: whatever the order, windows, open panes and late rows are all rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from streammetrics.operators.metrics import AGES_BY_YEAR, MEDALS_BY_YEAR
from streammetrics.session import list_partitions, scratch_path
from streammetrics.sources.files import read_stream
from streammetrics.streaming import eventjob
from streammetrics.streaming.eventjob import EventJobConfig, EventTimeJob

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "ts timestamp, year short, medal string, age short"


def _rows(seconds, year=2000, medal="Gold"):
    return [(None if s is None else T0 + timedelta(seconds=s), year, medal, 20) for s in seconds]


def _job(spark, window=20, slide=10, delay=5, metric=MEDALS_BY_YEAR, out=None, fold=200):
    base = scratch_path(spark, "events")
    cfg = EventJobConfig(metric, "ts", window, slide, delay, f"{base}/ckpt", out or f"{base}/out", True, fold)
    return EventTimeJob(spark, cfg), cfg


def _seconds(t):
    return None if t is None else int((t.replace(tzinfo=timezone.utc) - T0).total_seconds())


def _result(job, df):
    closed = {(_seconds(r["window_start"]), r["year"]): r["count"] for r in job.read_windows(df).collect()}
    open_ = {(_seconds(r["window_start"]), r["year"]): r["count"] for r in job.read_open(df).collect()}
    late = {(_seconds(r["pane"]), r["year"]): r["rows"] for r in job.read_late(df).collect()}
    return closed, open_, late


def _expected(batches, window, slide, delay):
    """The rule, row by row."""
    mark, kept, late = None, [], {}
    for rows in batches:
        newest = None
        for s, year in rows:
            pane = None if s is None else s // slide * slide
            if pane is None or mark is not None and pane + slide <= mark:
                late[pane, year] = late.get((pane, year), 0) + 1
            else:
                kept.append((pane, year))
            if s is not None:
                newest = s if newest is None else max(newest, s)
        if newest is not None:
            mark = newest - delay if mark is None else max(mark, newest - delay)
    closed, open_ = {}, {}
    for pane, year in kept:
        for start in range(pane - window + slide, pane + 1, slide):
            to = closed if start + window <= mark else open_
            to[start, year] = to.get((start, year), 0) + 1
    return closed, open_, late


@pytest.mark.parametrize("window,slide,delay,seed", [(20, 10, 5, 1), (10, 10, 0, 2), (30, 10, 17, 3)])
def test_random_orders_equal_the_rule(spark, window, slide, delay, seed):
    rng = random.Random(seed)
    job, cfg = _job(spark, window, slide, delay)
    batches = [[(None if rng.random() < 0.03 else max(0, 25 * b + rng.randint(-60, 30)), rng.choice([1996, 2000]))
                for _ in range(rng.randint(1, 40))] for b in range(6)]
    empty = spark.createDataFrame([], SCHEMA)
    for b, rows in enumerate(batches):
        df = spark.createDataFrame([r for s, year in rows for r in _rows([s], year)], SCHEMA)
        EventTimeJob(spark, cfg).process_batch(df, b)             # all it knows is on disk
    got, want = _result(job, empty), _expected(batches, window, slide, delay)
    assert got == want and want[2]
    # each row is in window/slide windows, or late
    n = sum(map(len, batches))
    assert sum(got[0].values()) + sum(got[1].values()) == (n - sum(got[2].values())) * (window // slide)
    for state in ("panes", "watermark"):
        assert len(list_partitions(spark, f"{cfg.output_dir}/state/{state}", "batch_id")) <= 2


def test_a_batch_that_runs_again_changes_nothing(spark, monkeypatch):
    job, cfg = _job(spark)
    batches = [[5, 12], [3, 31, 44], [8, 60, 95], [30, 99]]
    write = eventjob.write_batch_partition
    for b, rows in enumerate(batches):
        df = spark.createDataFrame(_rows(rows), SCHEMA)
        for broken in ("late", "panes", "watermark", None):        # lost after each write in turn, then whole
            def failing(frame, path, batch_id, *args):
                write(frame, path, batch_id, *args)
                if broken and path.endswith(broken):
                    raise RuntimeError("lost")

            monkeypatch.setattr(eventjob, "write_batch_partition", failing)
            try:
                EventTimeJob(spark, cfg).process_batch(df, b)
            except RuntimeError:
                pass
    assert _result(job, spark.createDataFrame([], SCHEMA)) == _expected([[(s, 2000) for s in r] for r in batches], 20, 10, 5)


def test_other_states_nothing_to_count_and_folded_tables(spark):
    job, cfg = _job(spark, 10, 10, 0, AGES_BY_YEAR, fold=2)
    empty = spark.createDataFrame([], SCHEMA)
    assert [df.count() for df in (job.read_windows(empty), job.read_open(empty), job.read_late(empty))] == [0, 0, 0]
    job.process_batch(empty, 0)
    job.process_batch(spark.createDataFrame(_rows([None, 1], medal=None), SCHEMA), 1)      # the predicate keeps none
    assert not list_partitions(spark, f"{cfg.output_dir}/state/panes", "batch_id")
    for b, s in enumerate([5, 15, 25, 35, 45, 55], 2):
        job.process_batch(spark.createDataFrame(_rows([s, s]), SCHEMA), b)
    rows = {_seconds(r["window_start"]): (r["aged"], r["youngest"], r["years_of_age"]) for r in job.read_windows(empty).collect()}
    assert rows == {s: (2, 20, 40) for s in (0, 10, 20, 30, 40)}
    assert list_partitions(spark, f"{cfg.output_dir}/tables/ages_by_year", "batch_id")[-1] == 7
    with pytest.raises(ValueError):
        EventJobConfig(MEDALS_BY_YEAR, "ts", 15, 10, 0, "c", "o")


def test_stream_of_json_messages_with_a_schema(spark):
    path = scratch_path(spark, "json")
    rows = [("a,1", 1), (None, 2), ("b�,2", 3)]
    spark.createDataFrame(rows, "message string, k int").write.json(path)
    stream = read_stream(spark, "json", path, payload="message", schema="message string, k int")
    out = scratch_path(spark, "json-out")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["a,1", "b�,2"]
    with pytest.raises(Exception, match="(?i)schema"):
        read_stream(spark, "json", path, payload="message")
