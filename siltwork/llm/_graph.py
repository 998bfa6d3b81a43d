"""Connected components by alternating large-star and small-star steps, finished in one task once few links are left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm._store import stage

#: Up to this many distinct links (16 bytes each) are joined in one task; more go through distributed steps.
FEW = 1_000_000


def apart(key: Column) -> Column:
    """The same integer, but not known to the planner as the key that a table is grouped by.

    A join with it shuffles the grouped table once more, small as it is, and only so can Spark split a skewed key of
    the other side: a side that is still in its aggregation's partitions cannot be read in parts.
    """
    return key.bitwiseXOR(F.lit(0).cast("long"))


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links, ascending, and of each the smallest node that it reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, parent = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while True:
        x, y = parent[a], parent[b]
        if (open_ := x != y).any():
            np.minimum.at(parent, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
            while (parent != (up := parent[parent])).any():
                parent = up
        else:
            return nodes, nodes[parent]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if got:
        node, root = roots(np.concatenate([u for u, _ in got]), np.concatenate([v for _, v in got]))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "component"])


def _mark(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.shiftright(F.xxhash64("u", "v"), 20)), F.lit(0)).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame, few: int = FEW, steps: int = 60) -> DataFrame:
    """(node, component), written, for every node of the links (u, v) of integers; component is the smallest node reachable.

    While more than ``few`` links are left, each step takes per-node minima (combined on the map side) and joins them
    back, so a node with many links is split like any skewed join key. Nothing but a count and a checksum reaches the
    driver. Links with a null end and loops are dropped.
    """
    edges = stage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(edges)
    for _ in range(steps):
        if mark[0] <= few:
            return stage(edges.repartition(1).mapInArrow(_joined, "node long, component long"), "components")
        # Large star: every node hands its larger neighbours the least node of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(apart(F.col("u")).alias("n"), F.least("m", "u").alias("m"))
        large = both.join(least, F.col("u") == F.col("n")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every node hands itself and its smaller neighbours the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(apart(F.col("u")).alias("n"), "m")
        small = large.join(least, F.col("u") == F.col("n")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stage(small.filter("u <> v").distinct(), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    heads = edges.select(F.col("v").alias("node")).distinct()
    return stage(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads.select("node", F.col("node").alias("component"))), "components")
