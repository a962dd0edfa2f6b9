"""Connected components of a link table, by hooking to the smallest neighbour and pointer jumping.

Every round each node hooks to its smallest neighbour (or itself), chains are
shortened by joining the table with itself, and links are redrawn between what
remains; the number of nodes left at least halves. Hubs cost nothing special:
the minimum is combined before the shuffle. Nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.sources.storage import materialize


def _shortened(parents: DataFrame) -> DataFrame:
    """(node, parent) with every parent a root."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        longer = materialize(
            parents.join(up, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"),
                (F.coalesce("above", "parent") != F.col("parent")).alias("moved"),
            )
        )
        parents = longer.select("node", "parent")
        if longer.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link; ``links`` has a and b."""
    links = links.where("a <> b").select("a", "b")
    edges = materialize(links.union(links.select("b", "a")).distinct())
    found = None
    while not edges.isEmpty():
        hooked = edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent"))
        roots = _shortened(materialize(hooked))
        if found is None:
            found = roots.select("node", F.col("parent").alias("component"))
        else:
            up = roots.select(F.col("node").alias("component"), F.col("parent").alias("above"))
            found = materialize(
                found.join(up, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
            )
        a = roots.select(F.col("node").alias("a"), F.col("parent").alias("x"))
        b = roots.select(F.col("node").alias("b"), F.col("parent").alias("y"))
        redrawn = edges.join(a, "a").join(b, "b").where("x <> y")
        edges = materialize(redrawn.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
