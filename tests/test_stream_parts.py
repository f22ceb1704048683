"""Parts of the checked streams: as many files as their size asks for, and still one micro-batch a part."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from streammetrics.plans.queries import message_lines
from streammetrics.session import child_names, scratch_path
from streammetrics.streaming import queries

COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"     # off, small tables too are dealt over several tasks


@pytest.fixture
def small_tasks(spark):
    before = spark.conf.get(COALESCE)
    spark.conf.set(COALESCE, "false")
    yield spark
    spark.conf.set(COALESCE, before)


def test_a_part_is_written_by_several_tasks(small_tasks, sf_dir):
    spark, path = small_tasks, scratch_path(small_tasks, "parts")
    queries._write_parts(spark, sf_dir, path)
    for k in range(queries.STREAM_BATCHES):
        assert len([n for n in child_names(spark, f"{path}/part={k}") if n.startswith("part-")]) > 1
    found = spark.read.text(path).select("value", F.col("part").cast("long"))
    wanted = message_lines(spark, sf_dir).select("value", F.pmod("orderkey", F.lit(queries.STREAM_BATCHES)).alias("part"))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_a_part_of_several_files_is_one_batch(small_tasks, sf_dir, monkeypatch):
    monkeypatch.setattr(queries, "_runs", {})
    rows = queries.stream_batch_counts(small_tasks, sf_dir).collect()
    part = F.pmod("orderkey", F.lit(queries.STREAM_BATCHES)).alias("part")
    wanted = message_lines(small_tasks, sf_dir).groupBy(part).count().collect()
    assert sorted((r.batch_id, r.lines) for r in rows) == sorted((r["part"], r["count"]) for r in wanted)


def test_event_time_parts_are_written_by_several_tasks(small_tasks, sf_dir, monkeypatch):
    kept = []
    monkeypatch.setattr(queries, "delete", lambda spark, path: kept.append(path))
    monkeypatch.setattr(queries, "_event_runs", {})
    assert {r.kind for r in queries.stream_late_rows(small_tasks, sf_dir).collect()} == {"closed", "open", "late"}
    stream = next(p for p in kept if p.endswith("/stream"))
    for part in child_names(small_tasks, stream):
        assert len([n for n in child_names(small_tasks, f"{stream}/{part}") if n.startswith("part-")]) > 1
