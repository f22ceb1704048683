"""Streaming queries registered for checks.

The message lines derived from the record table are written as four parts, by order key, each a folder of
text files, that arrive one after the other. The metrics job is restarted for each and reads it as one of four
micro-batches (``availableNow``) with a fixed clock and windows of two slides. Its running totals
must equal one batch aggregate over the accepted lines, its windows those of the lines of the last
two files. ``stream_from_feed`` runs the feed twice into the folder that the job reads.

A second run restarts for every step of ``IDLE_STEPS``: two parts, two idle slides, two more parts, two idle slides,
with windows of three slides, catalog tables and metrics of sums, least and greatest values and distinct counts. A third
reads the lines as binary messages.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import parse_lines
from ..operators.metrics import AGES_BY_YEAR, ATHLETES_BY_CITY, COUNT, MEDALS_BY_YEAR, SKETCH_BITS
from ..plans.queries import feed_sources, message_lines
from ..session import child_names, delete, exists, make_folder, move, scratch_path
from ..sinks.writers import drop_replaced
from ..sources.feed import write_feed
from ..sources.files import read_stream
from ..sources.tables import achievements
from .eventjob import EventJobConfig, EventTimeJob
from .job import JobConfig, MetricsJob, read_batches, read_global, read_windows

# Fixed values of the checked runs.
STREAM_BATCHES = 4
WINDOW_SECONDS = 20
SLIDE_SECONDS = 10
START = datetime(2024, 1, 1, tzinfo=timezone.utc)

IDLE_STEPS = (0, 1, None, None, 2, 3, None, None)    # part that arrives before each run of the second job
IDLE_WINDOW_SECONDS = 30
# Binary messages of one order in so many have no payload, or end in a byte that is no UTF-8.
NULL_PAYLOADS, BAD_PAYLOADS = 50, 13

# Records arrive in parts by event time, one order in so many a part late; panes of a week, windows of two.
EVENT_FILES, STRAGGLERS = 4, 7
EVENT_FILE_DAYS, EVENT_DELAY_DAYS, EVENT_SLIDE_DAYS, EVENT_WINDOW_DAYS = 600, 30, 7, 14
EVENT_START_DAY = 9132                                       # 1995-01-02

_runs: dict[tuple[str, str], str] = {}    # (application, tables) → output folder of the shared run
_event_runs: dict[tuple[str, str], tuple[EventTimeJob, DataFrame]] = {}
_idle_runs: dict[tuple[str, str], dict[str, str]] = {}    # … → copies of the second run's catalog tables


def _clock(batch_id: int) -> datetime:
    return START + timedelta(seconds=SLIDE_SECONDS * batch_id)


def _write_parts(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The message lines as a folder a part, of as many files as their size asks for."""
    part = F.pmod("orderkey", F.lit(STREAM_BATCHES)).alias("part")
    lines = message_lines(spark, sf_dir).hint("rebalance", "orderkey").select("value", part)
    lines.write.partitionBy("part").text(path)


def _arrive(spark: SparkSession, source: str, stream: str, name: str) -> None:
    """A part's files show up in the stream's folder, which is made if need be."""
    make_folder(spark, stream)
    if exists(spark, f"{source}/{name}"):
        move(spark, f"{source}/{name}", f"{stream}/{name}")


def run_on_message_lines(spark: SparkSession, sf_dir: str) -> str:
    """Run the job over the message lines; returns its output folder. The queries below share one run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        base = scratch_path(spark, "stream-job")
        _write_parts(spark, sf_dir, f"{base}/lines")
        cfg = JobConfig(WINDOW_SECONDS, SLIDE_SECONDS, 0, f"{base}/checkpoint", f"{base}/out",
                        source_path=f"{base}/stream", available_now=True)
        for k in range(STREAM_BATCHES):
            _arrive(spark, f"{base}/lines", f"{base}/stream", f"part={k}")
            MetricsJob(spark, cfg, clock=_clock).run()
        for name in ("lines", "stream"):
            delete(spark, f"{base}/{name}")
        _runs[key] = cfg.output_dir
    return _runs[key]


def run_with_idle_slides(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Run the second job; returns the folders with copies of its catalog tables, which are dropped."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _idle_runs:
        base = scratch_path(spark, "idle-job")
        _write_parts(spark, sf_dir, f"{base}/lines")
        prefix = f"idle_{base[-12:]}_"
        metrics = (MEDALS_BY_YEAR, AGES_BY_YEAR, ATHLETES_BY_CITY)
        cfg = JobConfig(IDLE_WINDOW_SECONDS, SLIDE_SECONDS, 0, f"{base}/checkpoint", f"{base}/out",
                        source_path=f"{base}/stream", available_now=True,
                        table_prefix=prefix, metrics=metrics, fold_totals=2)
        for k in IDLE_STEPS:
            if k is not None:
                _arrive(spark, f"{base}/lines", f"{base}/stream", f"part={k}")
            MetricsJob(spark, cfg, clock=_clock).run()     # a run without files is one tick of the clock
        copies = {}
        for m in metrics:
            for name in (m.id, f"{m.id}_global"):
                copies[name] = f"{base}/copies/{name}"
                spark.table(prefix + name).write.parquet(copies[name])
            spark.sql(f"DROP TABLE IF EXISTS {prefix}{m.id}")
            drop_replaced(spark, f"{prefix}{m.id}_global")
        for name in ("lines", "stream", "out", "checkpoint"):
            delete(spark, f"{base}/{name}")
        _idle_runs[key] = copies
    return _idle_runs[key]


def stream_medals_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_global(spark, run_on_message_lines(spark, sf_dir), "medals_by_year").drop("timestamp")


def stream_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_global(spark, run_on_message_lines(spark, sf_dir), "top_10_cities").drop("timestamp")


def stream_top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_global(spark, run_on_message_lines(spark, sf_dir), "top_10_countries_per_year").drop("timestamp")


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and records of each micro-batch."""
    return read_batches(spark, run_on_message_lines(spark, sf_dir)).select("batch_id", "lines", "records")


def stream_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medals by year in each window of two slides."""
    return read_windows(spark, run_on_message_lines(spark, sf_dir), "medals_by_year").select("batch_id", "year", "count")


def stream_window_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities in each window of two slides with the stamp that all rows of the window share."""
    return read_windows(spark, run_on_message_lines(spark, sf_dir), "top_10_cities").select(
        F.unix_micros("timestamp").alias("stamp"), "city", "count")


def stream_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-window CSV dumps of gold medals by year and region, read back; the folder gives the batch."""
    dumps = f"{run_on_message_lines(spark, sf_dir)}/dumps"
    paths = [f"{dumps}/{n}/top_10_countries_per_year" for n in child_names(spark, dumps)]
    rows = spark.read.csv(paths, schema="year short, region string, count long", emptyValue="", nullValue="\u0000")
    folder = F.regexp_extract(F.input_file_name(), r"/[0-9]{8}T[0-9]{6}-([0-9]{6})/top_10", 1)
    return rows.select(folder.cast("long").alias("batch_id"), "year", "region", "count")


def _window_number(stamp) -> Column:
    return (F.floor((F.unix_seconds(stamp) - int(START.timestamp())) / SLIDE_SECONDS)).cast("long").alias("slide")


def stream_idle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medals by year in the window of three slides that each slide gives, idle ones included."""
    rows = spark.read.parquet(run_with_idle_slides(spark, sf_dir)["medals_by_year"])
    return rows.select(_window_number(F.col("timestamp")), "year", COUNT)


def stream_catalog_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running totals that the catalog's view shows after the last batch."""
    return spark.read.parquet(run_with_idle_slides(spark, sf_dir)["medals_by_year_global"]).drop("timestamp")


def stream_ages_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, least and greatest values, merged over the batches."""
    return spark.read.parquet(run_with_idle_slides(spark, sf_dir)["ages_by_year_global"]).drop("timestamp")


def stream_distinct_athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct athletes by city: the merged sketches' estimate against an exact count. ``close`` says that they
    differ by at most four standard errors."""
    estimate = spark.read.parquet(run_with_idle_slides(spark, sf_dir)["athletes_by_city_global"])
    records = parse_lines(message_lines(spark, sf_dir)).where(ATHLETES_BY_CITY.predicate())
    exact = records.groupBy("city").agg(F.countDistinct("id").alias("athletes"))
    error = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
    return exact.join(estimate.select("city", COUNT, F.col("athletes").alias("estimate")), "city", "full").select(
        "city", COUNT, "athletes", (F.abs(F.col("estimate") - F.col("athletes")) <= error * F.col("athletes")).alias("close"))


def stream_binary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of binary message files with a schema of their own: null payloads are dropped, bytes that are
    no UTF-8 become U+FFFD."""
    base = scratch_path(spark, "messages")
    order = F.col("orderkey")
    body = F.when(order % NULL_PAYLOADS != 0, F.concat(
        F.col("value").cast("binary"), F.when(order % BAD_PAYLOADS == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))))
    message_lines(spark, sf_dir).select(body.alias("body"), order.alias("message")).write.parquet(f"{base}/messages")
    stream = parse_lines(read_stream(spark, "parquet", f"{base}/messages", payload="body", schema="body binary, message long"))
    (stream.select("id", "year", "city", "notes").writeStream.format("parquet")
     .option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/records")
     .trigger(availableNow=True).start().awaitTermination())
    delete(spark, f"{base}/messages")
    return spark.read.schema("id string, year short, city string, notes string").parquet(f"{base}/records")


def stream_from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed → job twice: the second feed run adds files that the restarted job picks up."""
    base = scratch_path(spark, "feed-job")
    cfg = JobConfig(SLIDE_SECONDS, SLIDE_SECONDS, 0, f"{base}/checkpoint", f"{base}/out",
                    source_path=f"{base}/stream", available_now=True)
    for k in (0, 1):
        events, regions = feed_sources(spark, sf_dir, f"{base}/files-{k}", F.pmod(F.col("id").cast("long"), F.lit(2)) == k)
        write_feed(spark, events, regions, f"{base}/stream", header=True)
        delete(spark, f"{base}/files-{k}")
        MetricsJob(spark, cfg).run()
    delete(spark, f"{base}/stream")
    return read_global(spark, cfg.output_dir, "top_10_countries_per_year").drop("timestamp")


def _event_job(spark: SparkSession, sf_dir: str) -> tuple[EventTimeJob, DataFrame]:
    """The event-time job over records whose stragglers come a file later; its run is shared."""
    base = scratch_path(spark, "event-job")
    day = F.unix_date(F.col("ts").cast("date"))
    records = achievements(spark, sf_dir, with_ts=True, with_keys=True, columns=("year", "medal")).select(
        "year", "medal", F.timestamp_micros(day * 86_400_000_000).alias("ts"),
        F.least(F.lit(EVENT_FILES - 1), F.floor((day - EVENT_START_DAY) / EVENT_FILE_DAYS)
                + (F.col("orderkey") % STRAGGLERS == 0).cast("int")).cast("int").alias("part"), "orderkey")
    records.hint("rebalance", "orderkey").drop("orderkey").write.partitionBy("part").parquet(f"{base}/records")
    cfg = EventJobConfig(MEDALS_BY_YEAR, "ts", EVENT_WINDOW_DAYS * 86_400, EVENT_SLIDE_DAYS * 86_400,
                         EVENT_DELAY_DAYS * 86_400, f"{base}/checkpoint", f"{base}/out", available_now=True)
    job = EventTimeJob(spark, cfg)
    make_folder(spark, f"{base}/stream")
    stream = spark.readStream.schema("year short, medal string, ts timestamp").parquet(f"{base}/stream/part=*")
    for name in sorted(n for n in child_names(spark, f"{base}/records") if n.startswith("part=")):
        _arrive(spark, f"{base}/records", f"{base}/stream", name)
        job.start(stream).awaitTermination()
    for name in ("records", "stream"):
        delete(spark, f"{base}/{name}")
    return job, stream


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time windows, closed and open, and the late rows by week, of one stream with stragglers."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _event_runs:
        _event_runs[key] = _event_job(spark, sf_dir)
    job, records = _event_runs[key]

    def day(column: str) -> Column:
        return F.date_from_unix_date((F.unix_micros(column) / 86_400_000_000).cast("int")).alias("start")

    windows = [df.select(F.lit(kind).alias("kind"), day("window_start"), "year", COUNT) for kind, df in (
        ("closed", job.read_windows(records)), ("open", job.read_open(records)))]
    late = job.read_late(records).select(F.lit("late").alias("kind"), day("pane"), "year", F.col("rows").alias(COUNT))
    return windows[0].unionByName(windows[1]).unionByName(late)


STREAM_QUERIES = {
    "stream_medals_by_year": stream_medals_by_year,
    "stream_top_cities": stream_top_cities,
    "stream_top_regions": stream_top_regions,
    "stream_batch_counts": stream_batch_counts,
    "stream_sliding_window": stream_sliding_window,
    "stream_from_feed": stream_from_feed,
    "stream_window_stamps": stream_window_stamps,
    "stream_dumps": stream_dumps,
    "stream_idle_windows": stream_idle_windows,
    "stream_catalog_global": stream_catalog_global,
    "stream_ages_by_year": stream_ages_by_year,
    "stream_distinct_athletes": stream_distinct_athletes,
    "stream_binary_messages": stream_binary_messages,
    "stream_late_rows": stream_late_rows,
}
