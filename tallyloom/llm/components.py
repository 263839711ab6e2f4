"""Connected components of a table of links, by hooking and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node reached.

    Every node points to a parent, at first itself. In a round, each link offers the
    grandparent of one end to the other end and to its parent; least offers win, and
    pointers are shortened. Rounds grow with the logarithm of the longest path. Offers
    are minima, so they are combined before every shuffle and a node with very many links
    never meets them in one task. Rounds are written to the shared folder.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("parent"))
    parents = stored(least.select(F.col("a").alias("node"), "parent"), "parents")
    while True:
        grand = parents.alias("x").join(
            parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand")), "parent"
        ).select("node", "parent", "grand")
        grand = stored(grand, "parents")
        offers = (
            both.join(grand.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy("a")
            .agg(F.min("grand").alias("offer"))
        )
        heard = grand.join(offers, grand["node"] == offers["a"]).select(
            "node", "parent", "grand", "offer"
        )
        votes = heard.select(
            F.explode(
                F.array(
                    F.struct(F.col("node").alias("node"), F.least("offer", "grand").alias("parent")),
                    F.struct(F.col("parent").alias("node"), F.col("offer").alias("parent")),
                )
            ).alias("vote")
        ).select("vote.*")
        new = stored(votes.groupBy("node").agg(F.min("parent").alias("parent")), "parents")
        moved = new.join(parents.withColumnRenamed("parent", "old"), "node").filter("parent < old")
        if moved.isEmpty():
            return new.select("node", F.col("parent").alias("root"))
        parents = new
