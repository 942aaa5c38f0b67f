"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewinds.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the least node that each node of ``links`` (``a, b``) reaches.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours its least neighbour, then its smaller neighbours. Rounds grow with the
    logarithm of the longest chain; each is stored, so no plan grows and a lost
    executor costs one round. A hub of many links is met by joins on its key,
    never by a window.
    """
    links = cut_lineage(links.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v").distinct())
    state = None
    while True:
        both = links.unionByName(links.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").selectExpr("v as u", "m as v").unionByName(down.selectExpr("u", "m as v"))
        links = cut_lineage(small.where("u <> v").distinct())
        row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    labels = links.selectExpr("u as node", "v as component")
    return labels.unionByName(links.selectExpr("v as node", "v as component").distinct())
