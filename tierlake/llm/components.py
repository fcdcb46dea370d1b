"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import broadcast_if_small, stored

#: Nodes that are sent to every task instead of shuffling.
BROADCAST_NODES = 500_000
LINKS_A_TASK = 20_000


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``): the smallest node reachable.

    Each round every node hooks onto its smallest neighbour, takes two jumps up
    the tree that makes, and links are carried over to the nodes reached. A
    link's larger end always moves down, so the links run out; a star is done in
    one round, and a chain shrinks by a factor each round. Rounds are stored in
    the shared folder.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = stored(links.distinct(), folder)
    # Few links need few tasks; there are never more of them than now.
    tasks = 1 + links.count() // LINKS_A_TASK
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hooks = hooks.select("node", F.least("node", "low").alias("up"))
        hooks = stored(hooks.coalesce(tasks), folder)
        small = broadcast_if_small(hooks, BROADCAST_NODES)
        over = small.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        over2 = small.select(F.col("node").alias("up2"), F.col("up").alias("up3"))
        reached = stored(
            hooks.join(over, "up").join(over2, "up2").select("node", F.col("up3").alias("top")),
            folder,
        )
        small = broadcast_if_small(reached, BROADCAST_NODES)
        if labels is None:
            labels = reached.select("node", F.col("top").alias("component"))
        else:
            step = small.select(F.col("node").alias("component"), "top")
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("top", "component").alias("component")
            )
            labels = stored(labels, folder)
        to_a = small.select(F.col("node").alias("a"), F.col("top").alias("top_a"))
        to_b = small.select(F.col("node").alias("b"), F.col("top").alias("top_b"))
        links = links.join(to_a, "a").join(to_b, "b").where("top_a <> top_b")
        links = links.select(
            F.least("top_a", "top_b").alias("a"), F.greatest("top_a", "top_b").alias("b")
        )
        links = stored(links.distinct().coalesce(tasks), folder)
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
