"""Output stamps and the folder names derived from them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMP = "timestamp"


def stamp_literal(ts: datetime) -> Column:
    """A literal stamp: naive datetimes become TIMESTAMP_NTZ, aware ones TIMESTAMP."""
    if ts.tzinfo is None:
        return F.to_timestamp_ntz(F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")))
    return F.lit(ts.astimezone(timezone.utc)).cast("timestamp")


def with_stamp(df: DataFrame, ts: datetime | Column, name: str = STAMP) -> DataFrame:
    """Add one constant stamp column shared by every row."""
    col = ts if isinstance(ts, Column) else stamp_literal(ts)
    return df.withColumn(name, col)


def stamp_folder(ts: datetime) -> str:
    """Folder name for a stamp: ``yyyyMMdd'T'HHmmss`` in UTC (no colons, which
    object stores and HDFS paths don't accept)."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc)
    return ts.strftime("%Y%m%dT%H%M%S")


def batch_folder(batch_id: int, width: int = 6) -> str:
    """Zero-padded batch id for folder names."""
    return f"{batch_id:0{width}d}"
