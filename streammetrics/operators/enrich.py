"""Enrichment: left outer equi-join of records with a static lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..schema import LOOKUP_KEY


def enrich(records: DataFrame, lookup: DataFrame, key: str = LOOKUP_KEY) -> DataFrame:
    """Left join ``records`` with ``lookup`` on ``key``.

    Output keeps the records' columns in order, then the lookup's other
    columns. Unmatched records get nulls; a key repeated in the lookup repeats
    the record. No hint is set: Spark broadcasts a lookup whose bytes are below
    ``spark.sql.autoBroadcastJoinThreshold`` (by estimate or, with AQE, as measured), so
    the records aren't shuffled; a larger one gets a sort-merge join in which AQE splits
    skewed partitions of the records. Works on batch and streaming records.
    """
    extra: Sequence[str] = [c for c in lookup.columns if c != key]
    return records.join(lookup, on=key, how="left").select(*records.columns, *extra)
