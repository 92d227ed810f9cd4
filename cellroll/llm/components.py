"""Connected components of a graph of links, by hashing every node to its smallest known neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b) of longs: the smallest node that can be reached.

    Alternates large-star and small-star steps: each takes every node's smallest neighbour m and links the
    node's larger (or smaller) neighbours and the node itself to m.  Both are joins with an aggregated
    minimum, so no node's neighbours are gathered in one task; a node of very many links is combined before
    the shuffle and its side of the join can be split.  Ends when the links are stars.
    """
    links = saved(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "links")
    while True:
        # large star: a node's larger neighbours are linked to its smallest neighbour (or itself)
        both = links.selectExpr("hi as node", "lo as other").unionByName(links.selectExpr("lo as node", "hi as other"))
        low = both.groupBy("node").agg(F.min("other").alias("m")).withColumn("m", F.least("node", "m"))
        large = links.selectExpr("lo as node", "hi as other").join(low, "node").selectExpr("m as lo", "other as hi").distinct()
        # small star: a node's smaller neighbours and itself are linked to the smallest of them
        small_low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(small_low, "hi").selectExpr("m", "lo", "hi")
        after = small.selectExpr("m as lo", "hi").unionByName(small.where("lo != m").selectExpr("m as lo", "lo as hi")).distinct()
        after = saved(after, "links")
        # stars: every node is the larger end of one link at most, and no centre is another's leaf
        leaves = after.groupBy("hi").agg(F.count("*").alias("n"))
        chained = after.select(F.col("lo").alias("hi")).distinct().join(leaves, "hi", "left_semi")
        if not leaves.where("n > 1").limit(1).count() and not chained.limit(1).count():
            break
        links = after
    return after.selectExpr("hi as node", "lo as component").unionByName(after.selectExpr("lo as node", "lo as component").distinct())
