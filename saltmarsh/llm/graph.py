"""Connected components of an edge table, by repeated joins; nothing is gathered in the driver but a count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, is_small, stored

#: Edges up to which one task joins them in memory (16 bytes an edge, a few times over).
TASK_EDGES = 4_000_000


def components(edges: DataFrame, rounds: int = 0) -> DataFrame:
    """node, label: the smallest node of its component, for each node of the undirected edges (u, v).

    Each round takes the smallest label of the neighbours, then follows labels to labels, so that
    the rounds grow with the logarithm of a component's width rather than with the width. Hot nodes are met by map-side
    minima and by AQE's split of skewed joins. Rounds are written to the shared folder. With `rounds` there are at most so
    many: a component then may come in parts, but no label joins two components.
    """
    both = stored(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct(), "edges")
    labels = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        rounds -= 1
        near = both.join(if_small(labels.withColumnRenamed("node", "v")), "v").groupBy("u").agg(F.min("label").alias("near"))
        least = labels.join(if_small(stored(near, "near")), labels.node == F.col("u")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        least = stored(least, "least")
        jump = if_small(least.select(F.col("node").alias("label"), F.col("label").alias("beyond")))
        new = stored(least.join(jump, "label").select("node", "old", F.least("label", "beyond").alias("label")), "labels")
        labels = new.select("node", "label")
        if rounds == 0 or new.filter("old <> label").isEmpty():
            return labels


def least_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of some edges, sorted, and the smallest node of each one's component."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        for side in (u, v):
            np.minimum.at(label, label[side], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
    return nodes, nodes[label]


def components_in_a_task(edges: DataFrame, rounds: int = 0, most: int = TASK_EDGES) -> DataFrame:
    """As `components`: stored edges (u, v) of at most `most` rows are joined whole by one task, more by its `rounds`."""
    if not is_small(edges, most):
        return components(edges, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(i).to_numpy() for i in range(2)] for b in batches]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in least_labels(*map(np.concatenate, zip(*parts, strict=True)))], ["node", "label"])

    return stored(edges.select("u", "v").filter("u <> v").coalesce(1).mapInArrow(run, "node long, label long"), "labels")
