"""Sinks: file dumps, append tables, versioned global tables, line output.

Every write is keyed so that running it again for the same batch replaces
what the first attempt wrote (dynamic partition overwrite), which makes a
retried micro-batch idempotent.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.lines import encode_lines
from ..session import exists

BATCH_ID = "batch_id"
FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro", "text")


def write_dump(df: DataFrame, path: str) -> None:
    """Per-window CSV dump without header or stamp; overwrite, so a retry is safe."""
    df.write.mode("overwrite").option("header", "false").csv(path)


def write_batch_partition(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                          options: Mapping[str, str] | None = None) -> None:
    """Append-style table partitioned by batch id; a retried batch replaces its
    own partition only (dynamic partition overwrite)."""
    w = (df.withColumn(BATCH_ID, F.lit(batch_id).cast("long")).write.format(fmt)
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_ID))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)


def append_table(df: DataFrame, table: str, batch_id: int, fmt: str = "parquet",
                 options: Mapping[str, str] | None = None) -> None:
    """Append one batch's rows to a catalog table, created when it isn't there.

    The table keeps all batches. A file-based table is partitioned by batch id and a retried batch
    replaces its own partition; any other is appended to unless it already has rows of the batch.
    """
    spark = df.sparkSession
    rows = df.withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
    if not spark.catalog.tableExists(table):
        w = rows.write.format(fmt).partitionBy(BATCH_ID)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.saveAsTable(table)
    elif fmt in FILE_FORMATS:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH_ID} = {batch_id}) "
                  f"SELECT {', '.join(f'`{c}`' for c in df.columns)} FROM {{rows}}", rows=df)
    elif spark.table(table).where(F.col(BATCH_ID) == batch_id).isEmpty():
        rows.writeTo(table).append()


def _version_tables(spark: SparkSession, name: str) -> dict[int, str]:
    """version → name of the tables ``<name>_v<version>`` (a catalog's listing by pattern)."""
    database, _, table = name.rpartition(".")
    prefix = f"{table}_v".lower()
    found = spark.catalog.listTables(database or None, f"{table}_v*")
    ends = {t.name[len(prefix):]: t.name for t in found if t.name.lower().startswith(prefix) and not t.isTemporary}
    return {int(end): f"{database}.{t}" if database else t for end, t in ends.items() if end.isdigit()}


def replace_table(df: DataFrame, name: str, version: int, keep_versions: int = 3, fmt: str = "parquet",
                  options: Mapping[str, str] | None = None) -> None:
    """Replace what ``name`` shows, at once: write a table of this version, then point the view at it.

    ``name`` is a view over the table ``<name>_v<version>``. Until ``CREATE OR REPLACE VIEW``, a single change in
    the catalog, readers see the version before, and a failure before it changes nothing for them. A retry of
    the same version replaces that version only. The newest ``keep_versions`` tables stay for readers that have
    already resolved the view. A plain table under ``name`` becomes its own version 0 first.
    """
    spark = df.sparkSession
    before = {}
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "VIEW":
            before = _version_tables(spark, name)
        else:
            spark.sql(f"ALTER TABLE {name} RENAME TO {name}_v0")
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_v0")
            before = {0: f"{name}_v0"}
    w = df.write.format(fmt).mode("overwrite")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.saveAsTable(f"{name}_v{version}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_v{version}")
    older = sorted((v for v in before if v < version), reverse=True)
    for v in older[max(keep_versions - 1, 0):]:
        spark.sql(f"DROP TABLE IF EXISTS {before[v]}")


def drop_replaced(spark: SparkSession, name: str) -> None:
    """Drop a view made by ``replace_table`` and all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for table in _version_tables(spark, name).values():
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def read_latest(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: StructType | None = None) -> DataFrame:
    """Newest version of a table written with ``write_batch_partition``.

    With the table's ``schema`` (without the batch id) a table that has no rows or files yet
    reads as an empty one.

    An older version stays readable while a newer partition is being written;
    where directory renames are atomic (HDFS, local disks) a reader never sees
    a half-written version, and on object stores the retained older versions
    give readers a complete fallback.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        if not exists(spark, path):
            return spark.createDataFrame([], schema)
        r = r.schema(StructType([*schema.fields, StructField(BATCH_ID, LongType())]))
    df = r.load(path)
    newest = df.agg(F.max(BATCH_ID).alias("m"))
    return df.join(F.broadcast(newest), df[BATCH_ID] == newest["m"]).drop("m", BATCH_ID)


def write_lines(records: DataFrame, path: str, columns=None, *, null_as_empty: bool = False,
                header: bool = False, mode: str = "overwrite",
                max_lines_per_file: int | None = None) -> None:
    """Records → text files of delimited lines (the queue / directory feed).

    ``max_lines_per_file`` bounds the size of each written file."""
    lines = encode_lines(records, columns, null_as_empty=null_as_empty)
    if header:
        names = ",".join(columns or records.columns)
        spark = records.sparkSession
        lines = spark.createDataFrame([(names,)], "value string").unionByName(lines)
    w = lines.write.mode(mode)
    if max_lines_per_file:
        w = w.option("maxRecordsPerFile", max_lines_per_file)
    w.text(path)
