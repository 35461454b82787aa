"""Most used items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def rank_within(counts: DataFrame, by: Sequence[str], item: str, k: int, n: str = "n") -> DataFrame:
    """The first k rows per group by ``n``, ties by name; adds ``place``.

    Spark keeps only k rows per group and task before it shuffles.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(n), F.asc(item))
    return (
        counts.withColumn("place", F.row_number().over(order).cast("bigint"))
        .filter(F.col("place") <= k)
    )


def top_k(df: DataFrame, by: Sequence[str], item: str, k: int) -> DataFrame:
    """The k most frequent items, overall or per group, ties by name."""
    counts = (
        df.filter(F.col(item).isNotNull()).groupBy(*by, item).agg(F.count("*").alias("n"))
    )
    if by:
        return rank_within(counts, by, item, k)
    return counts.orderBy(F.desc("n"), F.asc(item)).limit(k)
