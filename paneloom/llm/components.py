"""Connected components of an edge table, without bringing edges or components to the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.tables import Saved


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges with a > b."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the smallest node among the node and its neighbours."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("node", "other")
    smallest = both.groupBy("node").agg(F.min("other").alias("low"))
    lows = smallest.select("node", F.least("node", "low").alias("low"))
    return both.where("other > node").join(lows, "node").select(F.col("other").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    lows = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(lows, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(lows.select("a", F.col("low").alias("b")))


def connected_components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another; component is the smallest node reachable.

    Alternating large and small stars halve the depth of the trees until each node points to its
    root. Hot nodes cost one row per edge in a join whose large partitions Spark can split; minima
    are combined before each shuffle. Each round is written to the shared folder, the one before is
    deleted, and only a count and a checksum reach the driver. An edge with a null end or from a
    node to itself is ignored; an empty table gives an empty result.
    """
    held = Saved(_directed(edges.select(F.col(first).alias("a"), F.col(second).alias("b")).dropna()))
    sign = F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"))
    seen = held.df.agg(sign.alias("s")).first().s
    while seen.n:
        step = Saved(_directed(_small_star(_directed(_large_star(held.df)))))
        now = step.df.agg(sign.alias("s")).first().s
        held.drop()
        held = step
        if now == seen:
            break
        seen = now
    roots = held.df.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return held.df.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def local_star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same groups as the links give, as links to the smallest member."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]
