"""Quality classifier: hashed word n-gram logistic regression trained with FTRL (operator 10).

Words and word pairs are hashed into ``2**BITS`` features. Shards of a bounded labelled sample
are trained in parallel with follow-the-regularised-leader updates; after every pass the
shards' weights are averaged and handed to the next pass. Scoring is a sparse dot product.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import PieceCache, hash64, id_remainder, labelled, mix64, per_text, table

BITS = 18
TRAIN_DOCS = 8000     # expected number of labelled documents learned from
SHARDS = 4
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
THRESHOLD = 0.7

_PIECE = re.compile(r"\w+|[^\w\s]+")
_CAPS = hash64(b"\x00caps").to_bytes(8, "little")


def _piece_hashes(chunk: str) -> bytes:
    """Hashes of the words and punctuation marks of a whitespace-free chunk; capitals are marked."""
    out = []
    for p in _PIECE.findall(chunk):
        if len(p) > 1 and p.isupper():
            out.append(_CAPS)
        out.append(hash64(p.lower().encode("utf-8", "replace")).to_bytes(8, "little"))
    return b"".join(out)


def make_features():
    """text → distinct feature indices (0 is the bias) and their values.

    Word and word-pair counts are scaled to a unit vector. Three pseudo-words tell in tenths
    how much of the text is repeated word pairs, punctuation marks and words in capitals.
    """
    cache = PieceCache(_piece_hashes)
    caps, pseudo = np.frombuffer(_CAPS, np.uint64)[0], {}

    def shared(name: str, part: int, whole: int) -> int:
        key = (name, 10 * part // max(whole, 1))
        if key not in pseudo:
            pseudo[key] = (hash64(f"\x00{key}".encode()) >> (64 - BITS)) + 1
        return pseudo[key]

    def features(text: str) -> tuple[np.ndarray, np.ndarray]:
        chunks = text.split()
        h = np.frombuffer(cache.joined(chunks), np.uint64)
        pairs = mix64(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else h[:0]
        n_caps = int(np.count_nonzero(h == caps))
        marks = [0, shared("again", len(pairs) - len(np.unique(pairs)), len(pairs)),
                 shared("marks", len(h) - n_caps - len(chunks), len(h)), shared("caps", n_caps, len(chunks))]
        idx, tf = np.unique((np.concatenate([h, pairs]) >> np.uint64(64 - BITS)).astype(np.int64) + 1,
                            return_counts=True)
        tf = np.sqrt(tf)
        values = tf / max(float(np.sqrt((tf * tf).sum())), 1.0)
        return np.concatenate([np.array(marks), idx]), np.concatenate([np.ones(len(marks)), values])

    return features


def _probability(s: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(s, -35.0, 35.0))))


class Ftrl:
    """Follow-the-regularised-leader (proximal) state over the hashed features."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    @staticmethod
    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, idx: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(self.z[idx], self.n[idx])
        g = (_probability(float(w @ x)) - y) * x
        sigma = (np.sqrt(self.n[idx] + g * g) - np.sqrt(self.n[idx])) / ALPHA
        np.add.at(self.z, idx, g - sigma * w)
        np.add.at(self.n, idx, g * g)


def train(rows: DataFrame) -> np.ndarray:
    """Weights from (doc_id, text, label) rows, at most one bounded sample.

    Each pass trains ``SHARDS`` shards side by side from the averaged state of the last pass.
    No rows: all weights 0, so that every text scores 0.5.
    """
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    spark = rows.sparkSession
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int")).persist()
    try:
        for turn in range(PASSES):
            state = spark.sparkContext.broadcast((z, n))

            def fit(pdf: pd.DataFrame) -> pd.DataFrame:
                z0, n0 = state.value
                model, features = Ftrl(z0.copy(), n0.copy()), make_features()
                pdf = pdf.sort_values(["doc_id", "label", "text"])
                order = np.random.default_rng(turn).permutation(len(pdf))
                texts, labels = pdf["text"].to_numpy(), pdf["label"].to_numpy()
                for i in order:
                    idx, x = features(texts[i])
                    model.learn(idx, x, int(labels[i]))
                at = np.flatnonzero((model.z != z0) | (model.n != n0))
                return pd.DataFrame({"shard": pdf["shard"].iloc[0], "i": at, "z": model.z[at] - z0[at],
                                     "n": model.n[at] - n0[at]})

            # each shard's moves are averaged by Spark: at most 2**BITS rows reach the driver
            moved = (rows.groupBy("shard").applyInPandas(fit, "shard int, i long, z double, n double")
                     .groupBy("i").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow())
            if not moved.num_rows:
                break
            at = moved["i"].to_numpy()
            z[at] += moved["z"].to_numpy() / SHARDS
            n[at] += moved["n"].to_numpy() / SHARDS
    finally:
        rows.unpersist()
    return Ftrl.weights(z, n)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` of every whole text.

    Null counts as the empty text, scored by its pseudo-words alone; repeated rows score alike;
    other columns are not read. The broadcast weights have a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def setup():
        w, features = shared.value, make_features()

        def one(text: str) -> tuple[float, int]:
            idx, x = features(text)
            p = _probability(float(w[idx] @ x))
            return p, int(p >= threshold)

        return one

    return per_text(docs, None, "score double, predicted int", id_col, text_col, "", setup)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = train(labelled(spark, sf_dir, "quality", TRAIN_DOCS))
    docs = table(spark, sf_dir, "documents")
    return score(docs, weights).select(
        "doc_id", (id_remainder("doc_id", 4, 2) == 2).alias("held_out"), "score", "predicted")


QUERIES = {"op10_quality": op10_quality}
