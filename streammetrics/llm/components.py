"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammetrics.llm.common import materialize


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for nodes that aren't the smallest: the same components, fewest links."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inverse[:len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the component's smallest node.

    Every step aggregates with map-side combine and joins on the node, which adaptive
    execution splits where a node has very many links. Each half step is written to the shared
    checkpoint folder, so lineage stays short and no link reaches the driver.
    """
    edges = materialize(links.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = materialize(both.join(least, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = materialize(small.filter("a != b").distinct(), "small")
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == seen:
            break
        seen = sums
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
