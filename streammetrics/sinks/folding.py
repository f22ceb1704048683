"""Folding of append tables: the small partitions of closed batches become few large files.

A table written batch by batch has a folder ``batch_id=N`` for each batch. ``fold_batches`` writes the rows of
closed batches together into a segment under ``_folded`` and then names it in a manifest, one small file that appears
by a rename. ``read_folded`` reads the segments of the newest manifest and the partitions of later batches only.

* A crash before the manifest leaves the partitions as they were; the next fold writes the same segment again.
* Partitions and segments that a manifest has replaced are deleted by the next fold, not by this one, so readers that
  listed them before have one fold's time to end.
* A partition of a batch that the manifest covers is not read, so a batch that runs again adds nothing.
* Segments of one level merge into one of the next when there are ``TIER`` of them: a table has O(log batches) segments
  and fewer than two folds of partitions, and a row is rewritten once a level.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import child_names, delete, exists, list_partitions, read_small_file, size_of, write_small_file
from .writers import BATCH_ID

FOLDED = "_folded"           # hidden from readers of the plain partitions
TIER = 8                     # segments of a level that merge into one of the next
FILE_BYTES = 128 << 20       # size aimed at for a segment's files
_EMPTY = {"version": 0, "upto": -1, "segments": [], "replaced": []}


def _manifest_name(version: int) -> str:
    return f"manifest-{version:09d}.json"


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: ``upto`` (last batch folded), ``segments`` in order, ``replaced`` segments."""
    names = sorted(n for n in child_names(spark, f"{path}/{FOLDED}") if n.startswith("manifest-"))
    return json.loads(read_small_file(spark, f"{path}/{FOLDED}/{names[-1]}")) if names else dict(_EMPTY)


def _read(spark: SparkSession, fmt: str, paths: list[str], options: Mapping[str, str] | None,
          schema: StructType | None, base: str | None = None) -> DataFrame:
    r = spark.read.format(fmt).options(**(options or {}))
    if base:
        r = r.option("basePath", base)
    if schema is not None:
        r = r.schema(StructType([*schema.fields, StructField(BATCH_ID, LongType())]))
    df = r.load(paths)
    return df.withColumn(BATCH_ID, F.col(BATCH_ID).cast("long"))


def _write_segment(rows: DataFrame, path: str, name: str, size: int, fmt: str,
                   options: Mapping[str, str] | None) -> None:
    files = max(1, -(-size // FILE_BYTES))
    rows.coalesce(files).write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{path}/{FOLDED}/{name}")


def fold_batches(spark: SparkSession, path: str, before: int, every: int, fmt: str = "parquet",
                 options: Mapping[str, str] | None = None) -> bool:
    """Fold the partitions of batches below ``before`` once there are ``every`` of them; whether it did.

    One caller at a time (the job's batches follow each other)."""
    have = list_partitions(spark, path, BATCH_ID)
    if sum(b < before for b in have) < every:
        return False
    m = manifest(spark, path)
    open_ = [b for b in have if m["upto"] < b < before]
    if len(open_) < every:
        return False
    for b in have:                               # replaced by an earlier fold
        if b <= m["upto"]:
            delete(spark, f"{path}/{BATCH_ID}={b}")
    for name in m["replaced"]:
        delete(spark, f"{path}/{FOLDED}/{name}")

    parts = [f"{path}/{BATCH_ID}={b}" for b in open_]
    new = {"name": f"rows-{open_[0]}-{open_[-1]}-0", "level": 0}
    _write_segment(_read(spark, fmt, parts, options, None, path), path, new["name"],
                   sum(size_of(spark, p) for p in parts), fmt, options)
    segments, replaced = [*m["segments"], new], []
    while len(same := [s for s in segments if s["level"] == segments[-1]["level"]]) >= TIER:
        level = same[0]["level"] + 1
        first, last = same[0]["name"].split("-")[1], same[-1]["name"].split("-")[2]
        merged = {"name": f"rows-{first}-{last}-{level}", "level": level}
        paths = [f"{path}/{FOLDED}/{s['name']}" for s in same]
        _write_segment(_read(spark, fmt, paths, options, None), path, merged["name"],
                       sum(size_of(spark, p) for p in paths), fmt, options)
        segments = [*[s for s in segments if s not in same], merged]
        replaced += [s["name"] for s in same]
    write_small_file(spark, f"{path}/{FOLDED}/{_manifest_name(m['version'] + 1)}", json.dumps(
        {"version": m["version"] + 1, "upto": open_[-1], "segments": segments, "replaced": replaced}))
    for name in child_names(spark, f"{path}/{FOLDED}"):       # all but the newest two manifests
        if name.startswith("manifest-") and name < _manifest_name(m["version"]):
            delete(spark, f"{path}/{FOLDED}/{name}")
    return True


def read_folded(spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None,
                schema: StructType | None = None) -> DataFrame:
    """All rows of a table written batch by batch, folded or not, with their ``batch_id``.

    With the table's ``schema`` (without the batch id) a table that isn't there yet reads as an empty one."""
    if schema is not None and not exists(spark, path):
        return spark.createDataFrame([], StructType([*schema.fields, StructField(BATCH_ID, LongType())]))
    m = manifest(spark, path)
    parts = [f"{path}/{BATCH_ID}={b}" for b in list_partitions(spark, path, BATCH_ID) if b > m["upto"]]
    folded = [f"{path}/{FOLDED}/{s['name']}" for s in m["segments"]]
    frames = [_read(spark, fmt, paths, options, schema, base)
              for paths, base in ((folded, None), (parts, path)) if paths]
    if not frames:
        return _read(spark, fmt, [path], options, schema)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
