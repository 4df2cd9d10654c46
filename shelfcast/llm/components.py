"""Connected components by alternating large and small stars.

Each round turns the edges of every node towards the smallest node it can see; the edges end as stars
whose centres are the smallest nodes of their components. A round joins edges with per-node minima, so a
node with very many neighbours is an aggregate and a join key, never a list. Rounds are written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stage


def _checksum(edges: DataFrame) -> tuple:
    mark = F.xxhash64("node", "to").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (node, to) with to < node, re-hung on the least neighbour of the end they share."""
    both = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
    seen = both if large else edges
    least = seen.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("least"))
    if large:
        # Larger neighbours of a node move to its least neighbour (or stay at the node, if that is least).
        moved = both.where("to > node").join(least, "node").select(F.col("to").alias("node"), F.col("least").alias("to"))
    else:
        # A node and its smaller neighbours all move to the least of them.
        members = edges.join(least, "node")
        moved = members.select(F.explode(F.array("node", "to")).alias("node"), F.col("least").alias("to"))
    return moved.where("node <> to").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between nodes of an ordered type -> (node, component), the least node reachable.

    Only nodes that have a link to another one appear. Repeated links and self-links change nothing.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct()
    edges = stage(edges, "components")
    before = _checksum(edges)
    while before[0]:
        edges = stage(_star(_star(edges, large=True), large=False), "components")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("to").alias("node")).distinct()
    return edges.select("node", F.col("to").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
