"""Connected components of an edge table, by alternating large and small stars.

Kiveris et al., "Connected components in MapReduce and beyond" (2014). Each round takes a
minimum for each node (combined before the shuffle) and joins it back, so a hub's edges can
be split like any skewed join. Each round is written to the shared folder, and the one
before it deleted. A table of few edges is solved in one task, without rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import forget, keep, ship_code

#: Edges that one task takes, 16 MB of them.
FEW = 1 << 20


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): the smallest node it can reach.

    Nulls, loops and repeated edges change nothing; no edges give no rows. The result is kept
    in the shared folder, what led to it isn't.
    """
    now = keep(_clean(edges))
    mark = _mark(now)
    if mark[0] <= FEW:
        found = keep(_solved(now))
        forget(now)
        return found
    while mark[0]:
        before, now = now, keep(_small_star(_large_star(now)))
        after = _mark(now)
        forget(before)
        if after == mark:
            break
        mark = after
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")))
    found = keep(ends.groupBy("node").agg(F.min("component").alias("component")))
    forget(now)
    return found


def _labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges, sorted, and the smallest that each can reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        live = x != y
        a, b, x, y = a[live], b[live], x[live], y[live]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _solved(edges: DataFrame) -> DataFrame:
    """(node, component) of few edges, in one task."""
    ship_code(edges.sparkSession)

    def run(batches):
        held = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        held = [(a, b) for a, b in held if len(a)]
        if held:
            nodes, component = _labels(*map(np.concatenate, zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(component)], ["node", "component"])

    return edges.coalesce(1).mapInArrow(run, "node long, component long")


def _clean(edges: DataFrame) -> DataFrame:
    """Edges once each, the larger end first."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _clean(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _clean(moved.unionByName(least.select("a", F.col("m").alias("b"))))
