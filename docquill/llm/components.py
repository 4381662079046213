"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of links (a, b), two long columns; root is the least node reachable.

    Every round hangs all neighbours of a node under the least of them, first the larger ones, then all that
    are not larger. Rows never outnumber twice the links, and a round is written before the next one reads it. Links of a node
    with itself and repeated links count once.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = settled(edges, "links")
    for _ in range(most_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        fresh = settled(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now, before = _mark(fresh), _mark(edges)
        edges = fresh
        if now == before:
            break
    else:
        raise RuntimeError("links did not settle")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(tops)


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free digest of the links."""
    each = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(each)).first())
