"""Connected components by contraction; nothing but emptiness is asked by the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from targetlens.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of ``links`` (``a``, ``b``).

    ``component`` is the smallest node reachable. Each round hooks every label to its smallest
    neighbour, follows the hooks to their ends, and replaces the links by those between labels
    that still differ. All steps are joins and minima with map-side combining, so a node with very
    many links is not gathered. Nodes without a link are absent. An empty table gives an empty one.
    """
    edges = saved(links.where("a <> b").select("a", "b").distinct(), "links")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("low"))
        hooks = saved(hooks.select("a", F.least("a", "low").alias("to")), "hooks")
        hooks = _ends(hooks)
        labels = saved(_renamed(labels, hooks, "component"), "labels")
        edges = _renamed(_renamed(edges, hooks, "a"), hooks, "b")
        edges = saved(edges.where("a <> b").distinct(), "links")
    return labels


def _renamed(df: DataFrame, hooks: DataFrame, name: str) -> DataFrame:
    """``df`` with the column ``name`` replaced by what it hooks to, if it has a hook."""
    hooks = hooks.select(F.col("a").alias("_from"), F.col("to").alias("_to"))
    joined = df.join(hooks, df[name] == hooks["_from"], "left")
    return joined.withColumn(name, F.coalesce("_to", name)).select(df.columns)


def _ends(hooks: DataFrame) -> DataFrame:
    """Hooks followed to the label that hooks to itself."""
    while True:
        further = hooks.select(F.col("a").alias("_from"), F.col("to").alias("_to"))
        joined = hooks.join(further, hooks["to"] == further["_from"], "left")
        joined = joined.select("a", F.coalesce("_to", "to").alias("to"), F.col("to").alias("was"))
        step = saved(joined, "ends")
        hooks = step.select("a", "to")
        if step.where("`to` <> was").isEmpty():
            return hooks
