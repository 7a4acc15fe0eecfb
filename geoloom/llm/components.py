"""Connected components: forests within each task, then alternating large and small stars, every step a table in the shared folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage

#: Links that a task keeps before it replaces them by a forest of them.
KEPT_LINKS = 1 << 20


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least node reachable from each of n nodes over the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _contracted(edges: DataFrame) -> DataFrame:
    """(u, v): each node of a run of a task's links with the least that these links reach from it."""

    def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        label = forest(at[: len(u)], at[len(u) :], len(nodes))
        some = np.flatnonzero(label != np.arange(len(nodes)))
        return nodes[some], nodes[label[some]]

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            kept.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > KEPT_LINKS:
                kept = [stars(*(np.concatenate(c) for c in zip(*kept, strict=True)))]
                size = len(kept[0][0])
                if 2 * size > KEPT_LINKS:  # as good as it gets
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in kept[0]], ["u", "v"])
                    kept, size = [], 0
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in stars(*(np.concatenate(c) for c in zip(*kept, strict=True)))], ["u", "v"])

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(run, "u long, v long")


def _minimum(stage: Stage, edges: DataFrame) -> DataFrame:
    """The least neighbour of each first node. A table of its own, so that joins to it can split crowded nodes."""
    return stage.table(edges.groupBy("u").agg(F.min("v").alias("m")))


def _open(edges: DataFrame) -> bool:
    """Whether a node has two others, or is another's and has one itself."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("low"), F.col("v").alias("high")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("low"), F.col("v").alias("high")))
    return bool(ends.groupBy("node").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").limit(1).count())


def connected_components(stage: Stage, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable, for each node that a link names and that is not the least itself.

    Nodes are longs. Links may repeat, point either way or to the node itself. The number of rounds grows with the
    logarithm of the number of nodes; each round groups and joins on nodes only.
    """
    edges = stage.table(_contracted(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")).distinct())
    while _open(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _minimum(stage, both)
        large = stage.table(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        stage.drop(edges, least)
        least = _minimum(stage, large)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage.table(_contracted(small.unionByName(least.select("u", F.col("m").alias("v")))).distinct())
        stage.drop(large, least)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
