"""Connected components of a large edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import saved


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) with the components of the edges (a, b)."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))), F.lit(0)).alias("h"),
    ).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b).

    Large-star and small-star rounds of groupings and joins until the edge set
    no longer changes; then every edge is (node, smallest node reachable).
    The rounds' tables go to the shared checkpoint folder; the driver sees a
    count and a hash sum only. An empty edge table gives an empty result.
    """
    state, edges = None, saved(edges.where("a <> b").select("a", "b").distinct())
    while (now := _state(edges)) != state:
        state = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = (
            both.where("b > a")
            .join(low, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.least("m", "u").alias("b"))
            .distinct()
        )
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        linked = down.join(least, F.col("a") == F.col("u"))
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(linked.select("a", F.col("m").alias("b")))
        edges = saved(small.where("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
