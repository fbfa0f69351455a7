"""Connected components of a link table, by star contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import stash


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (longs, either order) to ``node, root``: the smallest node reachable.

    Alternates large and small stars: each node hands its neighbours the smallest one it
    knows, so paths halve and a hub is spread by its neighbours' keys. Every step is
    written to the shared work folder, which cuts the lineage. Only nodes of links appear.
    """
    def least(keyed: DataFrame) -> DataFrame:
        """Each node with the smallest neighbour; the rows stay one per link."""
        m = keyed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return keyed.join(m, "u")

    edges = stash(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = least(both).where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        large = stash(large, "large-star")
        met = least(large)
        small = met.selectExpr("v AS u", "m AS v").unionByName(met.selectExpr("u", "m AS v"))
        edges = stash(small.where("u <> v").distinct(), "small-star")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    roots = edges.selectExpr("v AS node", "v AS root").distinct()
    return edges.selectExpr("u AS node", "v AS root").unionByName(roots)
