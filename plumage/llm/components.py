"""Connected components of a link table, by contraction with repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import land


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable over ``links``.

    Every round points each node at its smallest neighbour, follows the
    pointers to their roots (jumping, so the distance halves each time), and
    replaces the links by those between different roots. So the link table
    shrinks from round to round until it is empty. Each step is written to the
    shared folder.
    """
    x, y = F.col(a), F.col(b)
    edges = land(links.where(x != y).select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct(),
                 "component-edges")
    nodes = None
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        roots = _roots(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("r")))
        if nodes is None:
            nodes = roots.select(F.col("x").alias("node"), F.col("r").alias("component"))
        else:
            step = roots.select(F.col("x").alias("component"), "r")
            nodes = land(nodes.join(step, "component", "left").select(
                "node", F.coalesce("r", "component").alias("component")), "component-nodes")
        of_x = roots.select("x", F.col("r").alias("rx"))
        of_y = roots.select(F.col("x").alias("y"), F.col("r").alias("ry"))
        edges = land(edges.join(of_x, "x").join(of_y, "y").where("rx <> ry").select(
            F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).distinct(), "component-edges")
        if not edges.take(1):
            return nodes


def _roots(pointers: DataFrame) -> DataFrame:
    """Pointers (x, r), r <= x, followed to the end."""
    pointers = land(pointers, "component-pointers")
    while True:
        ahead = pointers.select(F.col("x").alias("r"), F.col("r").alias("rr"))
        moved = land(pointers.join(ahead, "r").select("x", "r", "rr"), "component-pointers")
        pointers = moved.select("x", F.col("rr").alias("r"))
        if not moved.where("r <> rr").take(1):
            return pointers
