"""Connected components of a link table by alternating star contractions; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has a link to another node; the root is the smallest node reachable.

    Each round links the neighbours of a node to the smallest of them: first the larger ones, then the
    smaller ones. Links to oneself, repeated links and missing ends don't matter.
    """
    x, y = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    edges = links.where(f"{a} <> {b}").select(x.alias("u"), y.alias("v")).distinct()
    edges, state = _stored(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every link now leads from a node to a smaller one.
        large, _ = _stored(large.where("u <> v").distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("m").alias("v")))
        edges, new = _stored(small.where("u <> v").distinct())
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    out = settle(edges)
    row = out.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return out, tuple(row)
