"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark's own file systems."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the cluster's shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(col: str, modulus: int, of_null: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as ``of_null``."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % modulus, F.lit(of_null))


def hash_below(col: str, share: float, seed: int = 0) -> Column:
    """True for about ``share`` of the ids, chosen by their hash alone."""
    scale = 1 << 30
    return F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(scale)) < int(min(1.0, share) * scale)


def text_batches(batches: Iterator[pa.RecordBatch], of_null: str | None = "") -> Iterator[tuple[list, list]]:
    """(ids, texts) of Arrow batches whose first two columns are id and text, 256 rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column(1).to_pylist()
            if of_null is not None:
                texts = [of_null if t is None else t for t in texts]
            yield part.column(0).to_pylist(), texts


def per_text(df: DataFrame, fn: Callable[[str], tuple], fields: str, id_col: str = "doc_id",
             text_col: str = "text", of_null: str | None = "", setup: Callable | None = None) -> DataFrame:
    """id column plus ``fields`` of ``fn(text)`` for each row, Arrow batch by batch.

    ``setup`` builds ``fn`` once per task when it needs tables of its own.
    """
    from pyspark.sql.types import StructType
    out = StructType.fromDDL(fields)
    names = [id_col, *out.names]

    def run(batches):
        f = setup() if setup else fn
        for ids, texts in text_batches(batches, of_null):
            cols = list(zip(*[f(t) for t in texts])) if texts else [[] for _ in out.names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, arrow[0]), *[pa.array(list(c), t) for c, t in zip(cols, arrow[1:])]], names)

    from pyspark.sql.pandas.types import to_arrow_type
    arrow = [to_arrow_type(df.schema[id_col].dataType), *[to_arrow_type(f.dataType) for f in out.fields]]
    id_ddl = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_ddl}, {fields}")


class PieceCache(dict):
    """piece → bytes of its value, computed on first sight; emptied when it grows past ``limit``."""

    def __init__(self, compute: Callable[[str], bytes], limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, piece):
        value = self.compute(piece)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = value
        return value

    def joined(self, pieces: list) -> bytes:
        return b"".join(map(self.__getitem__, pieces))


def hash64(data: bytes, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(data, seed)


_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2**64 divided by the golden ratio


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def labelled(spark: SparkSession, sf_dir: str, label: str, bound: int, seed: int = 0) -> DataFrame:
    """(doc_id, text, label) of about ``bound`` labelled training documents, chosen by id hash.

    Learns only from ids whose crc32 remainder modulo 4 is not 2. A document with several
    label rows takes the largest; null labels are left out. The id list joined to the
    documents has about ``bound`` rows whatever the tables' size, so it is broadcast.
    """
    rows = (table(spark, sf_dir, "labels").filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .filter(id_remainder("doc_id", 4, 2) != 2))
    n = rows.count()
    chosen = (rows.filter(hash_below("doc_id", bound / max(n, 1), seed))
              .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
