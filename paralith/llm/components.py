"""Connected components of a graph of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralith.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """node, root: for every node of ``links`` (a bigint, b bigint) the smallest node that it reaches.

    A large-star round hangs the larger neighbours of each node on its smallest neighbour; a small-star round does so for the
    smaller ones.  Both keep the components, and the links end as stars.  Neighbours are never gathered: the smallest is an
    aggregate (combined before the shuffle), written and joined back to the links: between two tables the engine can split a hot
    node.  Each round is a table in the shared folder.  Null ends and loops are left out.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and u > v").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
