"""Groups along pairs of ids: connected components of a graph given as an edge table, by hooking and pointer jumping.

Edges point from a node to a smaller one. In each round a node's targets are hooked to the smallest
of them, and every edge jumps to its target's own smallest target, until all edges are stars.
Partitions may first contract their edges with union-find. Every round is written to the shared
folder, so lineage stays short and no part of the graph is held by the driver. A node's own edges
are few; the few targets that very many edges point to are broadcast.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

#: Edges that a task contracts at once.
BATCH_EDGES = 1 << 18
HUBS = 1000


class UnionFind:
    """Disjoint sets in which the smallest member names the set."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x], x = root, up
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _contract(batches):
    """Edges of a partition to (member, smallest member it reaches within the part)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def flush(sets):
        members = [x for x in sets.parent if sets.find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array([sets.find(x) for x in members], pa.int64())], schema=schema)

    sets, held = UnionFind(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
        held += batch.num_rows
        if held >= BATCH_EDGES:
            yield flush(sets)
            sets, held = UnionFind(), 0
    yield flush(sets)


def connected_components(edges: DataFrame, most_rounds: int = 60, contract: bool = True) -> DataFrame:
    """(node, component) for each node of the edges (a, b) of longs; component is the smallest node.

    Loops and repeated edges change nothing; an empty table gives an empty table. Edges that are
    few or come as forests need no ``contract`` first, which takes a Python process in each task.
    """
    real = edges.where("a != b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    stars = materialize((real.mapInArrow(_contract, "a long, b long") if contract else real).distinct())
    for _ in range(most_rounds):
        # In stars a node has one edge, and what has an edge is no node's target.
        ends = stars.select("a", F.lit(1).alias("out")).unionByName(stars.select(F.col("b").alias("a"), F.lit(0).alias("out")))
        if ends.groupBy("a").agg(F.sum("out").alias("n"), F.min("out").alias("least")).where("n > 1 or (n = 1 and least = 0)").isEmpty():
            break
        least = F.min("b").over(Window.partitionBy("a"))
        hooked = stars.withColumn("m", least).select(F.inline(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y"))))).where("x != y")
        parents = stars.groupBy(F.col("a").alias("y")).agg(F.min("b").alias("up"))
        # Targets of one part in HUBS of all edges or more, at most HUBS, are broadcast, and the rows that
        # point to them spread by their own end.
        hubs = stars.groupBy(F.col("b").alias("y")).agg(F.count("*").alias("n")).where(F.col("n") * HUBS >= stars.count()).select("y")
        hubs = hubs.join(parents, "y", "left").select("y", F.coalesce("up", "y").alias("hub_up"))
        met = hooked.join(F.broadcast(hubs), "y", "left").withColumn("key", F.when(F.col("hub_up").isNull(), F.col("y")).otherwise(F.xxhash64("x")))
        jumped = met.join(parents.select(F.col("y").alias("key"), "up"), "key", "left")
        stars = materialize(jumped.select(F.col("x").alias("a"), F.coalesce("hub_up", "up", "y").alias("b")).distinct())
    else:
        raise RuntimeError("the components' stars have not settled")
    own = stars.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)


def smallest_reachable(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, group): the smallest id that each id, a whole number, reaches over the pairs (a, b)."""
    found = connected_components(pairs.select("a", "b"))
    return ids.select("id").distinct().join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("group"))
