"""Connected components of an edge table by alternating stars; every round is a Spark job over the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import save


def _state(edges: DataFrame) -> tuple:
    row = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(u, label) for each node but the smallest of each component; ``label`` is the smallest node of it.

    ``edges`` has longs u > v. Each round hangs larger neighbours on a node's
    smallest one, then smaller ones too, until the edges are stars; the number of
    rounds grows with the logarithm of the longest chain.
    """
    edges = save(edges.where("u > v").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        edges = save(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(least.withColumnRenamed("m", "v")).distinct())
        state, before = _state(edges), state
        if state == before:
            break
    return edges.withColumnRenamed("v", "label")
