"""Batch and streaming sources: delimited files, text lines, message streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lines import decode_payload
from ..schema import LOOKUP_COLUMNS

# Null token for readers that must not detect nulls: a value no file contains.
_NO_NULL = "\u0001\u0002null\u0002\u0001"


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] | None = None, *,
                   sep: str = ",", quote: str = '"') -> DataFrame:
    """A delimited file with a header line, every column a string and no null
    detection: empty fields are ``""`` and ``NA`` stays the text ``NA``.

    ``columns`` renames the columns positionally (the header line is skipped
    either way); without it the header names are used.
    """
    r = (spark.read.option("header", "true").option("sep", sep).option("quote", quote)
         .option("escape", quote).option("nullValue", _NO_NULL).option("emptyValue", "")
         .option("mode", "FAILFAST").option("multiLine", "false"))
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = r.schema(schema).csv(path)
    else:
        df = r.option("inferSchema", "false").csv(path)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def read_regions(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """The regions file: header skipped, columns renamed to (noc, region, notes)."""
    return read_delimited(spark, path, LOOKUP_COLUMNS, sep=sep)


def read_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """One row per line in ``value``. ``header`` drops lines equal to it. A development
    run takes ``.limit(n)`` of the result."""
    df = spark.read.text(path)
    if header is not None:
        df = df.where(F.col("value") != F.lit(header))
    return df


def read_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                options: Mapping[str, str] | None = None,
                payload: str = "value", schema: str | T.StructType | None = None) -> DataFrame:
    """A message stream as ``value STRING``, one record per message.

    ``fmt`` is any streaming source present on the cluster (``text`` directory
    locally; ``kafka`` or another queue connector when deployed — its payload
    column is decoded as UTF-8 with invalid bytes replaced). Null messages are
    dropped. ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` in ``options``
    bound how much one micro-batch pulls. ``schema`` is that of message files
    which carry none for a stream (parquet, json, …).
    """
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(path) if path is not None else r.load()
    col = F.col(payload)
    text = col if isinstance(df.schema[payload].dataType, T.StringType) else decode_payload(col)
    return df.select(text.alias("value")).where(F.col("value").isNotNull())


def clock_ticks(spark: SparkSession) -> DataFrame:
    """A stream with one row in every micro-batch, whatever other sources have: beside them it makes a
    batch of each trigger. A run over what is there (``availableNow``) has one tick."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load())
