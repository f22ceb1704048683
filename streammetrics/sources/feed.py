"""The feed: events file ⋈ regions file → message lines in a stream folder.

A Spark job: both delimited files are read as plain strings (no null
detection), the events are left-joined with the regions on the country code,
and every record is written as one delimited line into a folder that the
metrics job reads as its stream: point the job's source path at OUT_DIR. Runs
append files with names of their own, so a later run adds to the stream, and a
file shows up only when its task has committed.

Usage: ``python -m streammetrics.sources.feed EVENTS REGIONS OUT_DIR [--header]``
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import enrich
from ..schema import EVENT_COLUMNS
from ..sinks.writers import write_lines
from .files import read_delimited, read_regions


def feed_records(spark: SparkSession, events_path: str, regions_path: str) -> DataFrame:
    """Events ⋈ regions as 17 string columns in record order (the events file's
    columns are taken positionally; its country code is the join key)."""
    events = read_delimited(spark, events_path)
    if len(events.columns) != len(EVENT_COLUMNS) - 2:
        raise ValueError(f"events file has {len(events.columns)} columns, "
                         f"expected {len(EVENT_COLUMNS) - 2}")
    events = events.toDF(*EVENT_COLUMNS[:-2])
    return enrich(events, read_regions(spark, regions_path))


def write_feed(spark: SparkSession, events_path: str, regions_path: str, out_dir: str, *,
               header: bool = False, max_lines_per_file: int | None = None) -> str:
    """Append the feed's lines to ``out_dir`` as new files; returns the folder.

    Nulls from unmatched joins are written as empty fields (the feed's form).
    """
    target = out_dir.rstrip("/")
    write_lines(feed_records(spark, events_path, regions_path), target, EVENT_COLUMNS, null_as_empty=True,
                header=header, mode="append", max_lines_per_file=max_lines_per_file)
    return target


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Write enriched record lines for the stream.")
    ap.add_argument("events", help="delimited events file (with header)")
    ap.add_argument("regions", help="delimited regions file (with header)")
    ap.add_argument("out_dir", help="folder the metrics job reads")
    ap.add_argument("--header", action="store_true", help="also write the header line")
    ap.add_argument("--max-lines-per-file", type=int)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("streammetrics-feed").getOrCreate()
    print(write_feed(spark, args.events, args.regions, args.out_dir, header=args.header,
                     max_lines_per_file=args.max_lines_per_file))
    return 0


if __name__ == "__main__":
    sys.exit(main())
