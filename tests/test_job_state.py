"""Idle slides, catalog versions, other states than counts, the log of totals, folded tables."""

from __future__ import annotations

import os
import time
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMALL, local_path
from streammetrics.functions.lines import parse_lines
from streammetrics.operators.metrics import (AGES_BY_YEAR, ATHLETES_BY_CITY, MEDALS_BY_YEAR, METRICS, SKETCH_BITS,
                                             combined_partials, merge_combined, split_partial)
from streammetrics.plans.queries import message_lines
from streammetrics.session import child_names, list_partitions, scratch_path, size_of
from streammetrics.sinks import folding, writers
from streammetrics.sinks.folding import fold_batches, manifest, read_folded
from streammetrics.sinks.writers import drop_replaced, read_latest, replace_table
from streammetrics.streaming.job import JobConfig, MetricsJob, read_batches, read_global, read_windows

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def parts(spark):
    """Four parts of the message lines, in memory."""
    lines = message_lines(spark, SMALL).select("value", F.pmod("orderkey", F.lit(4)).alias("k"))
    path = scratch_path(spark, "parts")
    lines.write.partitionBy("k").text(path)
    return [spark.read.text(f"{path}/k={k}") for k in range(4)]


def _cfg(spark, window=30, slide=10, metrics=(MEDALS_BY_YEAR,), **more):
    base = scratch_path(spark, "state")
    return JobConfig(window, slide, 0, f"{base}/ckpt", f"{base}/out", source_path=f"{base}/src", available_now=True,
                     metrics=metrics, **more)


def _clock(batch_id):
    return T0 + timedelta(seconds=10 * batch_id + 3)


def _nothing(spark):
    return spark.createDataFrame([(None,)], "value string")       # a tick


def _counts(df):
    return {r["year"]: r["count"] for r in MEDALS_BY_YEAR.local(parse_lines(df)).collect()}


def _add(*counts):
    out = {}
    for c in counts:
        for k, v in c.items():
            out[k] = out.get(k, 0) + v
    return out


def _windows(spark, cfg):
    out = {}
    for r in read_windows(spark, cfg.output_dir, "medals_by_year").collect():
        slide = int((r["timestamp"].replace(tzinfo=timezone.utc) - T0).total_seconds() // 10)
        out.setdefault((r["batch_id"], slide), {})[r["year"]] = r["count"]
    return out


# --- idle slides ------------------------------------------------------------------

def test_ticks_emit_each_idle_slide_and_the_trailing_windows(spark, parts):
    cfg = _cfg(spark)
    c = [_counts(p) for p in parts[:2]]
    steps = [parts[0], None, None, None, None, parts[1], None, None, None, None]
    for b, lines in enumerate(steps):
        # a new job for each batch: all it knows is on disk
        MetricsJob(spark, cfg, clock=_clock).process_batch(_nothing(spark) if lines is None else lines, b)
    assert _windows(spark, cfg) == {(0, 0): c[0], (1, 1): c[0], (2, 2): c[0], (5, 5): c[1], (6, 6): c[1], (7, 7): c[1]}
    assert {r["batch_id"]: r["lines"] for r in read_batches(spark, cfg.output_dir).collect()} == {
        0: parts[0].count(), 1: 0, 2: 0, 5: parts[1].count(), 6: 0, 7: 0}
    assert _add(*c) == {r["year"]: r["count"] for r in read_global(spark, cfg.output_dir, "medals_by_year").collect()}
    assert len(list_partitions(spark, f"{cfg.output_dir}/state/recent", "batch_id")) <= 4


def test_a_late_tick_brings_the_windows_it_slept_through_once(spark, parts):
    cfg = _cfg(spark)
    c = _counts(parts[0])
    at = {0: 3, 1: 15, 2: 16, 3: 58, 4: 59}
    job = MetricsJob(spark, cfg, clock=lambda b: T0 + timedelta(seconds=at[b]))
    job.process_batch(parts[0], 0)
    for b in (1, 2, 3, 4):
        job.process_batch(_nothing(spark), b)
    assert _windows(spark, cfg) == {(0, 0): c, (1, 1): c, (3, 2): c}


def test_a_tick_that_runs_again_changes_nothing(spark, parts, monkeypatch):
    cfg = _cfg(spark)
    c = [_counts(p) for p in parts[:2]]
    MetricsJob(spark, cfg, clock=_clock).process_batch(parts[0], 0)
    import streammetrics.streaming.job as module
    monkeypatch.setattr(module.MetricsJob, "_remember", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        MetricsJob(spark, cfg, clock=_clock).process_batch(_nothing(spark), 1)
    monkeypatch.undo()
    late = MetricsJob(spark, cfg, clock=lambda b: _clock(b) + timedelta(seconds=25))      # the rerun comes slides later
    late.process_batch(_nothing(spark), 1)
    assert _windows(spark, cfg) == {(0, 0): c[0], (1, 1): c[0]}
    MetricsJob(spark, cfg, clock=_clock).process_batch(parts[1], 2)
    assert _windows(spark, cfg) == {(0, 0): c[0], (1, 1): c[0], (2, 2): _add(*c)}


def test_tumbling_jobs_and_empty_states_ignore_ticks(spark, parts):
    for cfg in (_cfg(spark, window=10), _cfg(spark)):
        MetricsJob(spark, cfg, clock=_clock).process_batch(_nothing(spark), 0)
        assert not os.path.exists(local_path(cfg.output_dir))


def test_live_clock_gives_the_windows_after_the_last_line(spark, parts):
    base = scratch_path(spark, "live")
    parts[0].coalesce(1).write.text(f"{base}/src")
    cfg = JobConfig(6, 2, 0, f"{base}/ckpt", f"{base}/out", source_path=f"{base}/src", metrics=(MEDALS_BY_YEAR,))
    q = MetricsJob(spark, cfg).start()
    try:
        end = time.time() + 90
        while time.time() < end and len(child_names(spark, f"{base}/out/dumps")) < 3:
            time.sleep(0.5)
        time.sleep(5)           # further slides hold nothing
    finally:
        q.stop()
    stamps = {}
    for r in read_windows(spark, cfg.output_dir, "medals_by_year").collect():
        stamps.setdefault(r["timestamp"], {})[r["year"]] = r["count"]
    assert len(stamps) == 3 and all(v == _counts(parts[0]) for v in stamps.values())


# --- catalog versions ---------------------------------------------------------------

def _name(spark):
    return f"v{abs(hash(scratch_path(spark, 'name'))) % 10**9}"


def test_a_failed_replacement_leaves_the_version_before(spark, monkeypatch):
    name = _name(spark)
    df = spark.range(5).withColumnRenamed("id", "x")
    try:
        replace_table(df, name, 1)
        real = spark.sql

        def failing(text, *a, **k):
            if text.startswith("CREATE OR REPLACE VIEW"):
                raise RuntimeError("lost")
            return real(text, *a, **k)

        monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: failing(text, *a, **k))
        with pytest.raises(RuntimeError, match="lost"):
            replace_table(df.where("x < 2"), name, 2)
        monkeypatch.undo()
        assert spark.table(name).count() == 5                  # written, not swapped: readers see version 1
        replace_table(df.where("x < 3"), name, 2)              # the retry replaces its own version only
        assert spark.table(name).count() == 3
        assert spark.catalog.getTable(name).tableType == "VIEW"
    finally:
        drop_replaced(spark, name)
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(f"{name}_v2")


def test_versions_are_kept_for_readers_and_dropped_after(spark):
    name = _name(spark)
    try:
        for v in (3, 5, 8, 13):
            replace_table(spark.range(v), name, v, keep_versions=2)
        assert [spark.catalog.tableExists(f"{name}_v{v}") for v in (3, 5, 8, 13)] == [False, False, True, True]
        assert spark.table(name).count() == 13
    finally:
        drop_replaced(spark, name)


def test_a_plain_table_becomes_a_version(spark):
    name = _name(spark)
    try:
        spark.range(4).write.saveAsTable(name)
        replace_table(spark.range(6), name, 1)
        assert spark.table(name).count() == 6 and spark.table(f"{name}_v0").count() == 4
    finally:
        drop_replaced(spark, name)


# --- states ---------------------------------------------------------------------------

def test_states_merge_to_one_batch_aggregate(spark, parts):
    metrics = (*METRICS, AGES_BY_YEAR, ATHLETES_BY_CITY)
    records = [parse_lines(p) for p in parts]
    combined = [combined_partials(r, metrics) for r in records]
    union = combined[0]
    for c in combined[1:]:
        union = union.unionByName(c)
    merged = merge_combined(merge_combined(union, metrics).unionByName(combined[0].limit(0)), metrics)
    every = records[0].unionByName(records[1]).unionByName(records[2]).unionByName(records[3])
    for m in metrics:
        got = m.finish(m.results(split_partial(merged, metrics, m)))
        want = m.global_result(m.partial(every))
        assert got.columns == want.columns
        if m is not ATHLETES_BY_CITY:
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), m.id
    exact = {r["city"]: (r["n"], r["d"]) for r in every.where(ATHLETES_BY_CITY.predicate()).groupBy("city").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()}
    got = {r["city"]: r for r in got.collect()}
    assert set(got) == set(exact)
    for city, (n, d) in exact.items():
        assert got[city]["count"] == n and abs(got[city]["athletes"] - d) <= 4 * 1.04 / 2 ** (SKETCH_BITS / 2) * d + 0.5


def test_states_of_groups_without_values(spark):
    df = spark.createDataFrame([(1992, None, "Gold", None, "c"), (1996, 30, "Gold", "a", "c"), (1996, 20, None, "b", "c")],
                               "year short, age short, medal string, id string, city string")
    metrics = (AGES_BY_YEAR, ATHLETES_BY_CITY)
    combined = combined_partials(df.selectExpr("*", "cast(null as string) region"), metrics)
    ages = AGES_BY_YEAR.finish(AGES_BY_YEAR.results(split_partial(combined, metrics, AGES_BY_YEAR)))
    assert sorted(map(tuple, ages.collect())) == [(1992, 0, None, None, None, None), (1996, 1, 30, 30, 30, 30.0)]
    athletes = ATHLETES_BY_CITY.results(split_partial(combined, metrics, ATHLETES_BY_CITY))
    assert [tuple(r) for r in athletes.collect()] == [("c", 2, 1)]


# --- totals as base and log ------------------------------------------------------------

def test_a_slide_writes_its_own_keys_only(spark):
    cfg = _cfg(spark, window=10, metrics=METRICS, fold_totals=4)
    head = "1,A,M,24,180,80.5,T,AAA,1992 Summer,{},Summer,City{},S,E,Gold,R{},n"
    many = spark.createDataFrame([(head.format(1900 + k % 90, k, k),) for k in range(3000)], "value string").coalesce(1)
    few = spark.createDataFrame([(head.format(1992, 7, 7),)], "value string")
    sizes, bases = [], []
    for b in range(9):
        MetricsJob(spark, cfg, clock=_clock).process_batch(many if b == 0 else few, b)
        deltas = list_partitions(spark, f"{cfg.output_dir}/state/deltas", "batch_id")
        sizes.append(size_of(spark, f"{cfg.output_dir}/state/deltas/batch_id={b}"))
        bases.append(list_partitions(spark, f"{cfg.output_dir}/state/totals", "batch_id"))
        assert len(deltas) <= 8
    assert all(10 * s < sizes[0] for s in sizes[1:])                 # the log follows the batch's keys
    assert bases[:4] == [[0]] * 4 and bases[4] == [0, 4] and bases[5] == [4] and bases[8] == [4, 8]
    total = {r["city"]: r["count"] for r in read_global(spark, cfg.output_dir, "top_10_cities").collect()}
    assert total["City7"] == 9 and len(total) == 10


@pytest.mark.parametrize("crash", ["deltas", "totals", "_global"])
def test_a_crash_at_any_write_counts_nothing_twice(spark, parts, monkeypatch, crash):
    cfg = _cfg(spark, window=20, fold_totals=2)
    import streammetrics.streaming.job as module
    write = module.write_batch_partition
    for b in range(6):
        lost = []

        def failing(df, target, batch_id, *args):
            if target.endswith(crash) and not lost:
                if b % 2:
                    write(df, target, batch_id, *args)          # lost before or after the write
                lost.append(1)
                raise RuntimeError("lost")
            write(df, target, batch_id, *args)

        monkeypatch.setattr(module, "write_batch_partition", failing)
        try:
            MetricsJob(spark, cfg, clock=_clock).process_batch(parts[b % 4], b)
        except RuntimeError:
            pass
        monkeypatch.undo()
        if lost:
            MetricsJob(spark, cfg, clock=_clock).process_batch(parts[b % 4], b)
    c = [_counts(p) for p in parts]
    total = {r["year"]: r["count"] for r in read_global(spark, cfg.output_dir, "medals_by_year").collect()}
    assert total == _add(*c, c[0], c[1])
    assert _windows(spark, cfg) == {(b, b): c[0] if b == 0 else _add(c[b % 4], c[(b - 1) % 4]) for b in range(6)}


# --- folded tables -----------------------------------------------------------------------

def _put(path, batch, rows):
    folder = f"{local_path(path)}/batch_id={batch}"
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table({"x": pa.array(rows, pa.int64())}), f"{folder}/part-0.parquet")


def _rows(spark, path):
    return sorted((r["batch_id"], r["x"]) for r in read_folded(spark, path).collect())


def _files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(local_path(path)) for f in names)


def test_five_hundred_batches_leave_few_files(spark):
    path = scratch_path(spark, "appended")
    want = []
    for b in range(500):
        _put(path, b, [b, b + 1])
        want += [(b, b), (b, b + 1)]
        fold_batches(spark, path, b, 20)
        if b in (19, 20, 41, 333):
            assert _rows(spark, path) == want
    assert _rows(spark, path) == want
    assert _files(path) <= 2 * 20 + 2 * folding.TIER + 3
    assert len(manifest(spark, path)["segments"]) <= 2 * folding.TIER
    # a batch that is folded already runs again: its partition is there, its rows are not read twice
    _put(path, 100, [100, 101])
    assert _rows(spark, path) == want
    df = read_folded(spark, path)
    assert dict(df.dtypes) == {"x": "bigint", "batch_id": "bigint"}


def test_a_fold_lost_before_its_manifest_is_done_again(spark, monkeypatch):
    path = scratch_path(spark, "lost-fold")
    for b in range(6):
        _put(path, b, [b])
    monkeypatch.setattr(folding, "write_small_file", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        fold_batches(spark, path, 6, 5)
    monkeypatch.undo()
    assert _rows(spark, path) == [(b, b) for b in range(6)]
    before = read_folded(spark, path)
    assert fold_batches(spark, path, 6, 5) and not fold_batches(spark, path, 6, 5)
    assert sorted(r["x"] for r in before.collect()) == list(range(6))      # a reader from before the fold ends well
    assert _rows(spark, path) == [(b, b) for b in range(6)]


def test_the_batch_in_work_is_not_folded_and_an_empty_table_reads_empty(spark):
    path = scratch_path(spark, "open")
    schema = spark.range(0).withColumnRenamed("id", "x").schema
    assert read_folded(spark, path, schema=schema).count() == 0
    assert not fold_batches(spark, path, 5, 1)
    for b in range(4):
        _put(path, b, [b])
    fold_batches(spark, path, 3, 2)
    assert manifest(spark, path)["upto"] == 2
    _put(path, 3, [33])                                                    # runs again, replaced as before
    assert _rows(spark, path) == [(0, 0), (1, 1), (2, 2), (3, 33)]


def test_the_job_folds_its_tables_and_reads_all_windows(spark, parts):
    cfg = _cfg(spark, window=10, fold_tables=3)
    c = [_counts(p) for p in parts]
    for b in range(9):
        MetricsJob(spark, cfg, clock=_clock).process_batch(parts[b % 4], b)
    assert len(list_partitions(spark, f"{cfg.output_dir}/tables/medals_by_year", "batch_id")) <= 6
    assert manifest(spark, f"{cfg.output_dir}/tables/medals_by_year")["upto"] >= 5
    assert _windows(spark, cfg) == {(b, b): c[b % 4] for b in range(9)}
    assert read_batches(spark, cfg.output_dir).count() == 9
    job = MetricsJob(spark, cfg, clock=_clock)
    job.process_batch(parts[0], 8)                                         # the last batch again
    assert _windows(spark, cfg) == {(b, b): c[b % 4] for b in range(9)}
