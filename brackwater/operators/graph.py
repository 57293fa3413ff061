"""Connected components, for spatial clusters and raster regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written


def _rank(name: str) -> Column:
    """Nodes in an order that has nothing to do with their names, so that chains of better neighbours stay short."""
    return F.struct(F.xxhash64(name).alias("h"), F.col(name).alias("node"))


def linked(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have links (a, b), of any type with an order; the component is the smallest node reachable.

    Rounds of contraction: every node goes to its best-ranked neighbour, pointers are followed four steps, and
    the links between the nodes reached are the next, smaller graph. Only a constant share of the nodes is
    expected to be left, so rounds grow with the logarithm of the nodes, whatever the shape. Minima and distinct
    links have map-side sums; joins on a hub's name have unique keys on the other side.
    """
    kept = links.where("a <> b").select("a", "b")
    edges = written(kept.union(kept.select("b", "a")).distinct())
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        best = edges.groupBy("a").agg(F.min(_rank("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", _rank("a"))["node"].alias("up"))
        best = written(best)
        for _ in range(2):
            best = best.join(best.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up"))
        step = written(best)
        steps.append(step)
        near = edges.join(step.select(F.col("node").alias("a"), F.col("up").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        edges = written(near.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = steps[0]
    for step in steps[1:]:
        then = step.select(F.col("node").alias("up"), F.col("up").alias("top"))
        roots = roots.join(then, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
    roots = written(roots)
    return roots.join(roots.groupBy("up").agg(F.min("node").alias("component")), "up").select("node", "component")


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of all nodes (node) under links (a, b); nodes without links are their own component."""
    return nodes.join(linked(links), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
