"""Connected components of a table of links, by alternating large and small stars.

Every round replaces each node's links by links to the smallest node it knows; the number of rounds
grows with the logarithm of the longest path. Minima are combined in each task before the shuffle, so a
node with very many links is no hot group, and each round's links are a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def star(links: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours on one side of each node, and the node, to the smallest of them all."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if large else both.filter(F.col("b") < F.col("a"))
    least = side.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")) if large else side.groupBy("a").agg(F.min("b").alias("least"))
    joined = side.join(least, "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """node, root: the smallest node of its component, for every node in ``links`` (a, b).

    Links of a node to itself, repeated ones and both directions do no harm; nodes without links, and
    null ends, are not listed.
    """
    links = materialize(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        links = materialize(star(star(links, True), False), name)
        # The links of a finished round: each node to its root, which the next round would not change.
        found = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
