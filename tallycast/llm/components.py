"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in ``links`` (``a``, ``b``).

    Each round points every node at its smallest neighbour, follows the
    pointers to their ends and merges what they join; at least half of the
    nodes that still have a link go. All steps are joins and sums by node.
    Links from a node to itself are allowed; null ends are left out.
    """
    pairs = links.select("a", "b").filter("a is not null and b is not null")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialise(both)
    root = None
    while True:
        parent = edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root"))
        parent = materialise(parent)
        if parent.isEmpty():
            return root if root is not None else parent
        while True:  # follow the pointers
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            moved = materialise(parent.join(up, "root").select("node", "root", "_up"))
            parent = moved.select("node", F.col("_up").alias("root"))
            if moved.filter("root <> _up").isEmpty():
                break
        if root is None:
            root = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            root = root.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
        ends = [parent.select(F.col("node").alias(c), F.col("root").alias(f"_{c}")) for c in "ab"]
        merged = edges.join(ends[0], "a").join(ends[1], "b").filter("_a <> _b")
        edges = materialise(merged.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
