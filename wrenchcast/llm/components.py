"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of ``edges`` (a, b): root is the smallest node that it is connected with.

    Each round hooks every node to its smallest neighbour, follows these pointers to their ends by doubling, and
    contracts the edges; a round at least halves the nodes that still have edges. Minima are partial aggregates, so a
    node with very many edges is no bottleneck, and each round's tables are written to the checkpoint folder.
    """
    links = cut(edges.where("a <> b").select("a", "b").distinct())
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy("a").agg(F.min("b").alias("b"))
                     .select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        while True:  # parent of parent, until all point to the smallest node of their tree
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            stepped = cut(parent.join(up, "root").select("node", F.col("next").alias("root"),
                                                         (F.col("next") < F.col("root")).alias("moved")))
            parent = stepped.select("node", "root")
            if stepped.where("moved").isEmpty():
                break
        to = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = parent if labels is None else cut(
            labels.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        end = lambda side: parent.select(F.col("node").alias(side), F.col("root").alias("n" + side))
        links = cut(links.join(end("a"), "a").join(end("b"), "b").where("na <> nb")
                    .select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct())
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
