"""Connected components by alternating large-star and small-star steps over edge tables.

What is left is handed to one task as soon as it is a small graph, whose size has a bound: there a step's five
shuffles cost more than its edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.session import Scratch

#: Nodes of many edges that are broadcast at most (24 bytes each), and the edges that make a node one of them at least.
MOST_HUBS, HUB_EDGES = 100_000, 1000

#: Edges (16 bytes each) that one task takes at most.
SMALL_GRAPH = 100_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stars (u, v) of all edges of a task; a root is always its tree's smallest node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    stars = [(x, find(x)) for x in root]
    stars = [s for s in stars if s[0] != s[1]]
    yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in stars], pa.int64()) for i in (0, 1)], names=["u", "v"])


def _with_least(edges: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """The edges (u, v) with their u's m. The edges of a hub stay where they are, instead of meeting in one task.

    A node is a hub from 2 * n_edges / MOST_HUBS edges on, so that there are MOST_HUBS at most.
    """
    hub = F.col("edges") >= max(HUB_EDGES, -(-2 * n_edges // MOST_HUBS))
    marked = edges.join(F.broadcast(least.where(hub).select("u", F.col("m").alias("hub_m"))), "u", "left")
    others = marked.where("hub_m is null").select("u", "v").join(least.where(~hub).select("u", "m"), "u")
    return others.unionByName(marked.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")))


def components(scratch: Scratch, edges: DataFrame, label: str) -> DataFrame:
    """node, component (the smallest node that is reachable) of every node of an edge table (a, b).

    An empty table gives no rows; loops and repeated edges are allowed. Each step is written to the shared
    folder; they end when a step changes nothing, which is when the edges form stars.
    """
    now = scratch.table(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct(), f"{label}-0")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = now.agg(F.count("*"), digest).first()
    for step in count(1) if before[0] else ():
        if before[0] <= SMALL_GRAPH:
            now = scratch.table(now.coalesce(1).mapInArrow(_union_find, "u long, v long"), f"{label}-small")
            break
        # large-star: every larger neighbour goes to the smallest neighbour
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("edges"))
        large = _with_least(both, least, before[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: every smaller neighbour and the node itself go to the smallest one
        smallest = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("edges"))
        kept = _with_least(large, smallest, before[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = kept.union(smallest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = scratch.table(small, f"{label}-{step}")
        mark = now.agg(F.count("*"), digest).first()
        scratch.drop(f"{label}-{step - 1}")
        if mark == before:
            break
        before = mark
    return nodes.join(now, nodes["node"] == now["u"], "left").select("node", F.coalesce("v", "node").alias("component"))
