"""Connected components of a distributed edge list.

Alternating large-star and small-star passes over (u, v) rows; every pass is a
min-aggregation and a join by node, so no link, node or component ever comes to
the driver, which only reads one sum for the convergence test.  Hubs are safe:
the minimum is pre-aggregated and the join's large side can be split.

Few links are joined up by one task instead, which spares them the passes' many stages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.llm import kernels as K
from warpline.llm.storage import drop_shared, shared_table

#: links that one task joins up, at most (some 100 bytes each); more go through passes
FEW = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node to the least of them and itself: the
    greater neighbours (large) or the smaller ones (small)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    rows = both.join(least, "u")
    if large:
        rows = rows.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        rows = rows.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return rows.where(F.col("u") != F.col("v")).distinct()


def joined_up(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (u, v), and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        high, low = np.maximum(root[a], root[b]), np.minimum(root[a], root[b])
        apart = high != low
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = [(batch["u"].to_numpy(), batch["v"].to_numpy()) for batch in batches]
        if links:
            node, least = joined_up(*(np.concatenate(x) for x in zip(*links, strict=True)))
            rest = node != least
            yield pa.RecordBatch.from_arrays([pa.array(node[rest]), pa.array(least[rest])], ["node", "component"])

    return edges.coalesce(1).mapInArrow(K.tidy(run), "node long, component long")


def components(edges: DataFrame, most_passes: int = 60) -> DataFrame:
    """(u, v) -> (node, component): the least node of each node's component, for
    every node that has an edge to another one and isn't the least itself."""
    edges = shared_table(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if edges.count() <= FEW:
        found = shared_table(_in_one_task(edges))
        drop_shared(edges)
        return found
    mark = None
    for _ in range(most_passes):
        new = shared_table(_star(_star(edges, large=True), large=False))
        state = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        drop_shared(edges)
        edges = new
        if (state.n, state.s) == mark:
            break
        mark = (state.n, state.s)
    else:
        raise RuntimeError(f"no convergence in {most_passes} passes")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
