"""Joining a per-group value back to the rows of the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def join_group_values(df: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join ``values`` (one row per key) to ``df``; NULL keys match each other.

    Spark decides by measured size: it broadcasts small values, and beyond that
    splits the partition of a hot key at run time.
    """
    left, right = df.alias("l"), values.alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    added = [F.col(f"r.{c}") for c in values.columns if c not in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return left.join(right, condition, "left").select("l.*", *added)
