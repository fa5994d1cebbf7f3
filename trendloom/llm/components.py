"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.storage import stored

JUMPS = 3  # pointer jumps per round


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of every linked node's component.

    Each round hooks every node to its smallest neighbour, shortens the chains by pointer
    jumping and contracts the links to the ends of the chains; the links of a finished
    component vanish. Rounds are logarithmic in the longest chain. Every step is a join or
    a minimum with map-side combine, so a node with a third of all links does not gather
    them in one task. NULL ends and self links are ignored; repeated links do no harm. No
    links give an empty table.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(
        F.col("u") != F.col("v"))
    edges = stored(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                   .distinct(), "links")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near")).select(
            "node", F.least("node", "near").alias("to"))
        for _ in range(JUMPS):
            hooks = stored(hooks, "hooks")
            hops = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
            hooks = hooks.join(hops, "to", "left").select(
                "node", F.coalesce("next", "to").alias("to"))
        hooks = stored(hooks, "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("to").alias("component"))
        else:
            labels = labels.join(hooks.withColumnRenamed("node", "component"), "component",
                                 "left").select("node", F.coalesce("to", "component")
                                                .alias("component"))
        labels = stored(labels, "labels")
        for end in ("u", "v"):
            edges = edges.join(hooks.withColumnRenamed("node", end), end).drop(end) \
                .withColumnRenamed("to", end)
        edges = stored(edges.where(F.col("u") != F.col("v")).select(
            F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    return labels
