"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklake.session import settle


def _least(pairs: DataFrame) -> DataFrame:
    """Each node with the least of its neighbours and itself."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(links: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is the least node that can be reached.

    ``links`` has two columns of one type. Large-star and small-star steps take turns until
    nothing changes: each hangs nodes under the least neighbour, so that every component
    ends as a star, after about log(size) rounds. The least neighbour is found with a partial result per task and
    handed back by a join that Spark splits at very large stars. Each round is written to the shared folder.
    """
    u, v = (F.col(c) for c in links.columns)
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    edges, before = settle(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.distinct(), "large-star")
        small = large.join(_least(large), "u")
        star = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        edges = settle(star.where("u <> v").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias(node), F.col("v").alias(root))
        before = state
