"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order``; ties go to the greatest row.

    The best row per key is kept while aggregating before the shuffle, so each
    task sends one row per key even when one key has most of the rows.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys])
    ranked = F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], rest.alias("row"))
    best = df.groupBy(*keys).agg(F.max(ranked).alias("best"))
    return best.select(*keys, "best.row.*").select(*[F.col(f"`{c}`") for c in df.columns])
