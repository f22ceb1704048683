"""Corpus pipeline: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the
shared checkpoint folder and rereads as the next stage's documents. All but the last return
the columns of ``documents``. Stage decisions take effect:

toxicity       rows whose score reaches the threshold go; the model learns from the labelled part of ``documents``
near_dedup     of each component of near copies one row stays, that with the smallest id if any has one
decontaminate  rows that hold a benchmark item go
pii            personal data are replaced by their kind in brackets, n_chars is counted anew
packing        pieces with their place in sequences

Rows without an id are scored, redacted and packed like others. Null and empty texts are clean
and free of personal data, but they are near copies of each other, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streammetrics.llm import decontaminate, packing, pii, simhash, toxicity
from streammetrics.llm.common import labelled, materialize, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the rows that the toxicity model rejects."""
    model = toxicity.train(labelled(spark, sf_dir, "toxic", toxicity.TRAIN_DOCS))
    return toxicity.keep_clean(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of ``docs`` for each group of near copies."""
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the rows that hold an item of the table ``benchmark``."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with personal data replaced in their texts."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of ``docs`` with their place in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Compression lengths, SimHash components and tiling have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written and read again; the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
