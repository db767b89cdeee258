"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscore.llm.common import written


def components(links: DataFrame, max_turns: int = 60) -> DataFrame:
    """(node, component) of every linked node; links: (a, b) longs.

    A component's number is its smallest node. Each turn joins every node's
    larger neighbours, then its smaller ones, to the smallest neighbour; the
    table never grows and settles after a number of turns that is about the
    logarithm of the longest path. A node with very many neighbours costs one
    aggregate, never a gathered list."""
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "edges")
    for _ in range(max_turns):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))
        after = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        changed = after.exceptAll(edges).limit(1).count() or edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
