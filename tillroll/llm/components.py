"""Connected components of an edge table, by alternating large-star and
small-star steps until the edges stand still.

Each step takes one minimum per node (partial minima before the shuffle),
writes it, and joins it back on the node. Because the minima are a table of
their own, both sides of that join are plain shuffles, and adaptive execution
can split a hot node's edges over many tasks. Every round is written to the
shared folder, so lineage stays short. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.staging import drop_table, stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
                    F.sum(F.xxhash64("v", "u") % 1000003).alias("s")).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    # At most one edge out per edge in; the small star drops repeats.
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; two longs,
    loops and repeats allowed); component is the smallest node reachable."""
    spark = edges.sparkSession
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "edges")
    before = _state(now)
    while True:
        after = stage(_small_star(stage(_large_star(now), "edges")), "edges")
        state = _state(after)
        drop_table(spark, now)
        now = after
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct())


def star_edges(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node of a small symmetric boolean matrix to the first
    node of its component, for nodes that are linked at all."""
    n = len(linked)
    label = np.arange(n)
    while True:
        best = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1)) if n else label
        best = np.minimum(best, best[best])
        if np.array_equal(best, label):
            break
        label = best
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]
