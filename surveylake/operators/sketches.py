"""Distinct values from stored sketches that add up over batches, editions or any other parts.

A part keeps a theta sketch per column: a sample of hashes of its distinct values with a fixed
bound, the whole set while it fits. Sketches of parts are united, intersected and
subtracted without reading an answer again, and a changed part replaces its own only.
Up to ``2 ** lg`` distinct values the results are exact; beyond, a union is off by about
``1 / sqrt(2 ** lg)`` (0.8 % at 14), an intersection by that share of the union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Entries of a sketch are 2 ** LG.
LG = 14


def distinct_sketches(df: DataFrame, by: Sequence[str], cols: Sequence[str], lg: int = LG) -> DataFrame:
    """``by..., column, sketch``: a row per group and column; NULL is no value. One aggregation, combined before its shuffle."""
    # as text, so that one sketch holds any type
    made = [F.theta_sketch_agg(F.col(f"`{c}`").cast("string"), lg).alias(f"_s{i}") for i, c in enumerate(cols)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return df.groupBy(*by).agg(*made).select(*by, F.inline(F.array(*rows)))


def united(sketches: DataFrame, by: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """``by..., column, sketch`` of coarser groups, or of everything."""
    return sketches.groupBy(*by, "column").agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def distinct_values(sketches: DataFrame, by: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """``by..., column, distinct_values`` over all parts of a group."""
    return united(sketches, by, lg).select(*by, "column", F.theta_sketch_estimate("sketch").alias("distinct_values"))


def compared(sketches: DataFrame, first: Column, second: Column, lg: int = LG) -> DataFrame:
    """``column, first, second, both, either, gone, new``: distinct values of two sets of parts, given as conditions.

    ``gone`` are those of the first set only, ``new`` those of the second only. A set without parts has none.
    """
    two = sketches.groupBy("column").agg(*[
        F.theta_union_agg(F.when(side, F.col("sketch")), lg).alias(name) for side, name in ((first, "_a"), (second, "_b"))])
    a, b, size = F.col("_a"), F.col("_b"), F.theta_sketch_estimate
    return two.select(
        "column", size(a).alias("first"), size(b).alias("second"), size(F.theta_intersection(a, b)).alias("both"),
        size(F.theta_union(a, b, F.lit(lg))).alias("either"), size(F.theta_difference(a, b)).alias("gone"), size(F.theta_difference(b, a)).alias("new"))
