"""Connected components by alternating large-star and small-star contraction.

(Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014.) Every round is two
aggregations and two joins over the edges; it needs about log^2 rounds of the longest path. Each round's
edges are written to the scratch folder and read back.

Before the first round and after each one, every task replaces the edges it holds by a forest: stars around the least
node of each part that its edges connect. That keeps what is connected, leaves fewer edges than nodes, and shortens paths
by what a task can see, so that fewer rounds are needed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.skew import HOT_ROWS, lookup
from kinfold.scratch import Scratch

# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_ROUNDS = 200
#: Edges that a task holds at a time.
FOREST_EDGES = 1_000_000


def least_reachable(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """For each of the nodes 0 to ``nodes`` - 1 the least one that edges ``a``, ``b`` connect it with."""
    root = np.arange(nodes)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        # Hang each root under the least root that it meets, then point all nodes to the new roots.
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, again := root[root]):
            root = again


def _forests(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def forest(edges: pd.DataFrame) -> pd.DataFrame:
            names, places = np.unique(np.concatenate([edges["node"].to_numpy(object), edges["other"].to_numpy(object)]), return_inverse=True)
            root = least_reachable(places[: len(edges)], places[len(edges) :], len(names))
            leaf = np.flatnonzero(root != np.arange(len(names)))
            return pd.DataFrame({"node": names[leaf], "other": names[root[leaf]]})

        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            while len(held) >= size:
                yield forest(held.iloc[:size])
                held = held.iloc[size:]
        if held is not None and len(held):
            yield forest(held)

    return run


def _as_forests(edges: DataFrame, size: int) -> DataFrame:
    """Edges that connect the same nodes: in each task, stars around least nodes."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.schema)
    return edges.mapInPandas(_forests(size), kinds)


def _neighbour_minimum(directed: DataFrame, edges: int, hot_rows: int) -> DataFrame:
    """``(node, other, least)``: each directed edge with the least neighbour of its node."""
    least = directed.groupBy("node").agg(F.min("other").alias("least"), F.count("*").alias("degree"))
    return lookup(directed, least, ["node"], "degree", edges, hot_rows=hot_rows)


def _large_star(edges: DataFrame, count: int, hot_rows: int) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    linked = _neighbour_minimum(both, 2 * count, hot_rows).withColumn("least", F.least("least", "node"))
    moved = linked.filter(F.col("other") > F.col("node"))
    return moved.select(F.col("other").alias("node"), F.col("least").alias("other"))


def _small_star(edges: DataFrame, count: int, hot_rows: int) -> DataFrame:
    """Every node and its smaller neighbours move to the least of those neighbours."""
    linked = _neighbour_minimum(edges, count, hot_rows)
    pair = F.array(
        F.struct(F.col("other").alias("node"), F.col("least").alias("other")),
        F.struct(F.col("node"), F.col("least").alias("other")),
    )
    return linked.select(F.inline(pair)).filter(F.col("node") != F.col("other"))


def _is_settled(edges: DataFrame, count: int) -> bool:
    """Whether the edges are stars around their least nodes: one edge per node, and no centre is a leaf."""
    if edges.select("node").distinct().count() < count:
        return False
    inner = edges.join(edges.select(F.col("other").alias("centre")), F.col("node") == F.col("centre"), "left_semi")
    return inner.isEmpty()


def connected_components(
    edges: DataFrame, src: str, dst: str, scratch: Scratch, hot_rows: int = HOT_ROWS, forest_edges: int = FOREST_EDGES
) -> DataFrame:
    """``(node, component)`` for every node with an edge; a component is named after its least node."""
    a, b = F.col(src), F.col(dst)
    start = edges.filter(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
    start = _as_forests(start, forest_edges).distinct()
    name = "edges-0"
    current = scratch.materialise(start, name)
    count = current.count()
    for round_number in range(1, MAX_ROUNDS + 1):
        if not count or _is_settled(current, count):
            break
        stars = _large_star(current, count, hot_rows).distinct()
        step = _as_forests(_small_star(stars, count, hot_rows).distinct(), forest_edges).distinct()
        following = scratch.materialise(step, f"edges-{round_number}")
        scratch.discard(name)
        name, current = f"edges-{round_number}", following
        count = current.count()
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("other").alias("node")).distinct()
    members = current.select("node", F.col("other").alias("component"))
    return members.unionByName(roots.select("node", F.col("node").alias("component")))


def assign_clusters(nodes: DataFrame, components: DataFrame, id_column: str) -> DataFrame:
    """One row per node; a node without an edge is a cluster of its own."""
    joined = nodes.select(id_column).join(components, F.col(id_column) == F.col("node"), "left")
    return joined.select(
        F.col(id_column).cast("string").alias(id_column),
        F.coalesce("component", id_column).cast("string").alias("cluster_id"),
    )
