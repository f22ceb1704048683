"""Exact top-k inner-product search with MaxScore (operator 1).

A query's terms are its non-zero dimensions, each with the sign of its weight. A term's posting
list in a shard holds the vectors to which it contributes more than zero, ordered by impact,
and its score bound is the largest contribution there. With the current k-th best score as
threshold, the weakest terms whose bounds together stay below it are non-essential: a vector in
none of the essential lists can't get in. Essential postings are traversed and summed, the other
terms probed from the strongest on while a candidate stays competitive. Shards are searched
independently and their top k merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammetrics.llm.common import materialize, table

SHARD = 4096      # candidates searched in one piece
BLOCK = 512       # queries that meet a shard in one piece
SEEDS = 64        # postings taken from each of the strongest lists for the first threshold
PROBE = 8         # non-essential terms probed between two looks at the threshold


class Shard:
    """Impact-ordered posting lists and score bounds of one shard's integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], vectors[order]
        self.high = np.maximum(self.x.max(axis=0, initial=0), 0)
        self.low = np.minimum(self.x.min(axis=0, initial=0), 0)
        self.by_impact = np.argsort(-self.x, axis=0, kind="stable")
        self.positive = (self.x > 0).sum(axis=0)
        self.negative = (self.x < 0).sum(axis=0)

    def postings(self, d: int, up: bool, first: int | None = None) -> np.ndarray:
        """Rows with a positive (``up``) or negative component, strongest first."""
        if up:
            return self.by_impact[:self.positive[d], d][:first]
        return self.by_impact[len(self.ids) - self.negative[d]:, d][::-1][:first]

    def top(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best other vectors, ties to the smaller id."""
        terms = np.flatnonzero(q)
        bounds = np.maximum(q[terms] * self.high[terms], q[terms] * self.low[terms])
        strongest = np.argsort(-bounds, kind="stable")
        terms, bounds = terms[strongest], bounds[strongest]

        def kth(scores: np.ndarray):
            return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None

        seeds = np.unique(np.concatenate([np.empty(0, np.int64), *[
            self.postings(d, q[d] > 0, SEEDS) for d in terms[:4]]])).astype(np.int64)
        seeds = seeds[self.ids[seeds] != own]
        threshold = kth(self.x[seeds] @ q)
        # tail[i]: most that terms i, i + 1, ... can add together
        tail = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])
        if threshold is None or threshold <= 0:
            essential, rows = len(terms), np.arange(len(self.ids))  # no list may be left out
        else:
            essential = int(np.argmax(tail < threshold))
            inside = np.zeros(len(self.ids), bool)
            for d in terms[:essential]:
                inside[self.postings(d, q[d] > 0)] = True
            rows = np.flatnonzero(inside)
        rows = rows[self.ids[rows] != own]
        part = self.x[np.ix_(rows, terms[:essential])] @ q[terms[:essential]]
        for at in range(essential, len(terms), PROBE):
            keep = part + tail[at] >= threshold
            rows, part = rows[keep], part[keep]
            group = terms[at:at + PROBE]
            part = part + self.x[np.ix_(rows, group)] @ q[group]
        best = np.lexsort([self.ids[rows], -part])[:k]
        return self.ids[rows[best]], part[best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def search(vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
           shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and integer score of each query's ``k`` best candidates.

    Components become floor(256 * x). Rows with a null id, a null vector or a null or non-finite
    component take no part. Of rows with one id the smallest vector counts, so repeated
    rows count once. Vectors of different lengths are compared as if filled up with zeros. With
    fewer than ``k`` candidates all are returned; an empty table gives none.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))))
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    rows = materialize(rows.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"),
                    F.count_if(is_query(F.col("id"))).alias("queries")).first()
    width = size["width"] or 0
    shards, blocks = max(1, -(-size["n"] // shard)), max(1, -(-size["queries"] // block))
    part = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    candidates = rows.withColumn("shard", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = (rows.filter(is_query(F.col("id")))
               .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def find(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(given):
            x, q = _matrix(given["v"], width), _matrix(asked["v"], width)
            largest = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1)
            if largest < 2.0 ** 53:  # sums are exact in doubles, and their products faster
                x, q = x.astype(np.float64), q.astype(np.float64)
            index = Shard(given["id"].to_numpy(), x)
            for own, vector in zip(asked["id"], q):
                ids, scores = index.top(own, vector, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = queries.groupBy("block", "shard").cogroup(candidates.groupBy("block", "shard")).applyInPandas(
        find, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op1_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, 5)


QUERIES = {"op1_maxscore_topk": op1_maxscore_topk}

ORACLE_SQL = {"op1_maxscore_topk": """
    WITH good AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    vectors AS (SELECT vec_id, min(v) AS v FROM good GROUP BY vec_id),
    queries AS (
        SELECT vec_id AS query_id, UNNEST(v) AS w, generate_subscripts(v, 1) AS d FROM vectors WHERE vec_id % 50 = 0),
    parts AS (SELECT vec_id, UNNEST(v) AS x, generate_subscripts(v, 1) AS d FROM vectors),
    scores AS (
        SELECT query_id, vec_id, CAST(sum(w * x) AS BIGINT) AS score
        FROM queries JOIN parts USING (d) WHERE vec_id <> query_id GROUP BY query_id, vec_id),
    ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scores)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""}
