"""Toxicity by compression distance with two zstandard dictionaries (operator 7).

Training finds the text segments (word beginnings and whole words) that toxic documents use
more than ordinary ones, counted over distinct contexts so that copies count once. The toxic
dictionary holds these segments and the common ordinary ones, the ordinary dictionary the
latter only. A window is one word between two copies of a fixed frame; its gain is the number
of bytes that the toxic dictionary saves over the ordinary one. A document's score is a
logistic function of how many windows gain at least 2, 3, ... bytes, absolutely and per word,
with weights calibrated on the training documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import (PieceCache, hash64, id_remainder, labelled, per_text, table)

TRAIN_DOCS = 8000        # expected number of labelled documents learned from
PREFIXES = range(3, 10)  # word beginnings considered, in letters
TOXIC_SEGMENTS = 2000    # most toxic segments kept; with the next bound, the dictionary's size
COMMON_SEGMENTS = 400    # most frequent ordinary segments, in both dictionaries
LEAST_SHARE = 0.1        # of the largest log-likelihood ratio that a toxic segment must reach
LEAST_RATIO = 6.0        # of its rates in toxic and ordinary contexts
GAINS = (2, 3, 4, 5, 6, 7)
FRAME = b"0123456789abcdefghijklmnopqrstuvwxyz"  # fixed text around a window, known to both dictionaries
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Model:
    toxic: bytes = b""
    common: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 + 2 * len(GAINS)))

    def gain(self):
        """word → one byte: bytes saved by the toxic dictionary, 0 to 255."""
        def compressor(content: bytes):
            return zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content + FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=zstandard.ZstdCompressionParameters(
                    window_log=17, chain_log=15, hash_log=15, search_log=6, min_match=4, target_length=64,
                    strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False))

        toxic, ordinary = compressor(self.toxic + self.common), compressor(self.common)

        def saved(word: str) -> bytes:
            window = FRAME + f" {word} ".encode() + FRAME
            return bytes([min(max(len(ordinary.compress(window)) - len(toxic.compress(window)), 0), 255)])

        return saved

    def features(self):
        """text → bias and, for each gain, log counts of the windows reaching it (plain, per 1,000 words)."""
        cache = PieceCache(self.gain())
        at_least = np.array(GAINS)

        def of(text: str) -> np.ndarray:
            gains = np.frombuffer(cache.joined(words(text)), np.uint8)
            counts = np.bincount(gains, minlength=256)[::-1].cumsum()[::-1][at_least]
            return np.concatenate([[1.0], np.log1p(counts), np.log1p(1000.0 * counts / max(len(gains), 1))])

        return of


def _contexts(batches):
    """(label, word, hash of the word with its neighbours)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            d = batch.slice(at, 64).to_pydict()
            label, word, around = [], [], []
            for text, y in zip(d["text"], d["label"]):
                w = words(text)
                label += [y] * len(w)
                word += w
                around += [hash64(f"{a} {b} {c}".encode()) for a, b, c in zip(["", *w], w, [*w[1:], ""])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(word, pa.string()),
                 pa.array(np.array(around, np.uint64).view(np.int64))], ["label", "word", "around"])


def segments(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Toxic segments, most telling last, and common ordinary segments, most frequent last."""
    found = rows.select("text", "label").mapInArrow(_contexts, "label int, word string, around long").distinct()
    per_word = found.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).persist()
    try:
        total = per_word.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
        if not total["a"] or not total["b"]:
            return [], []
        na, nb = float(total["a"]), float(total["b"])
        starts = F.array(*[F.when(F.length("word") >= k, F.concat(F.lit(" "), F.substring("word", 1, k)))
                           for k in PREFIXES], F.concat(F.lit(" "), "word", F.lit(" ")))
        seg = (per_word.select(F.explode(F.array_compact(starts)).alias("seg"), "a", "b")
               .groupBy("seg").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b")))

        def bits(k, p):  # 0 log 0 = 0
            return F.when(k > 0, k * F.log(p)).otherwise(0.0)

        p = (F.col("a") + F.col("b")) / (na + nb)
        ratio = 2 * (bits(F.col("a"), F.col("a") / na) + bits(F.col("b"), F.col("b") / nb)
                     + bits(na - F.col("a"), 1 - F.col("a") / na) + bits(nb - F.col("b"), 1 - F.col("b") / nb)
                     - bits(F.col("a") + F.col("b"), p) - bits(na + nb - F.col("a") - F.col("b"), 1 - p))
        telling = (seg.filter(F.col("a") / na >= LEAST_RATIO * (F.col("b") + 0.5) / nb)
                   .select("seg", ratio.alias("g")).orderBy(F.desc("g"), F.desc(F.length("seg")), "seg")
                   .limit(TOXIC_SEGMENTS).collect())
        common = seg.filter("b > 0").orderBy(F.desc("b"), F.desc(F.length("seg")), "seg").limit(COMMON_SEGMENTS).collect()
    finally:
        per_word.unpersist()
    least = max(10.83, LEAST_SHARE * telling[0]["g"]) if telling else 0  # 10.83: the 0.1 % point of chi-squared
    kept: list[str] = []
    for r in telling:  # of nested beginnings the most telling stays, the longest on a tie
        if r["g"] >= least and not any(k.startswith(r["seg"]) or r["seg"].startswith(k.rstrip()) for k in kept):
            kept.append(r["seg"])
    return kept[::-1], [r["seg"] for r in common][::-1]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(rows: DataFrame) -> Model:
    """Dictionaries and weights from (doc_id, text, label) rows, one bounded sample.

    Without both labels the model knows nothing and scores every text 0.5.
    """
    rows = rows.persist()
    try:
        toxic, common = segments(rows)
        if not toxic and not common:
            return Model()
        model = Model("".join(toxic).encode(), "".join(common).encode())

        def setup():
            f = model.features()
            return lambda text: (f(text).tolist(),)

        # one short vector for each document of the bounded sample
        got = per_text(rows.select(
            F.col("label").alias("id"), "text"), None, "x array<double>", "id", "text", "", setup).toArrow()
    finally:
        rows.unpersist()
    x = np.array(got["x"].to_pylist()).reshape(got.num_rows, -1)
    order = np.lexsort([got["id"].to_numpy(), *x.T])
    model.weights = _fit(x[order], got["id"].to_numpy()[order].astype(float))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` of every whole text.

    A null text counts as empty; a text without words has the score of a text without gains.
    Repeated rows score alike; other columns are not read. The broadcast model has a bounded size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        features, w = shared.value.features(), shared.value.weights

        def one(text: str) -> tuple[float, int]:
            p = float(1 / (1 + np.exp(-np.clip(features(text) @ w, -35, 35))))
            return p, int(p >= threshold)

        return one

    return per_text(docs, None, "score double, predicted int", id_col, text_col, "", setup)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``; rows and columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, w = shared.value.features(), shared.value.weights
        bar = np.log(threshold / (1 - threshold))
        for texts in batches:
            yield texts.map(lambda t: bool(features(t or "") @ w < bar)).astype(bool)

    return docs.filter(clean(text_col))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train(labelled(spark, sf_dir, "toxic", TRAIN_DOCS))
    return score(table(spark, sf_dir, "documents"), model).select(
        "doc_id", (id_remainder("doc_id", 4, 2) == 2).alias("held_out"), "score", "predicted")


QUERIES = {"op7_toxicity": op7_toxicity}
