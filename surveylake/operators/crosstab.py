"""Crossing two variables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from surveylake.operators.weights import count, weight


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, rounded to 4 places; NULL when there is no base."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), 4)


def pair_counts(df: DataFrame, a: str, b: str, answered_only: bool = False) -> DataFrame:
    if answered_only:
        df = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return df.groupBy(a, b).agg(count(weight(df)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, answered_only: bool = False) -> DataFrame:
    """``a, b, n, row_pct, col_pct, total_pct``, one row per pair that occurs.

    The percentages are taken from the counted pairs, never from the answers.
    NULL is a group of its own unless ``answered_only``.
    """
    counts = pair_counts(df, a, b, answered_only)
    total = counts.agg(F.sum("n")).scalar()
    n = F.col("n")
    return counts.select(
        a, b, "n",
        percent(n, F.sum("n").over(Window.partitionBy(a))).alias("row_pct"),
        percent(n, F.sum("n").over(Window.partitionBy(b))).alias("col_pct"),
        percent(n, total).alias("total_pct"),
    )


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence[str]) -> DataFrame:
    """One row per ``a``, one column per given value of ``b``; 0 where none occurs."""
    return df.groupBy(a).pivot(b, list(values)).count().fillna(0, list(values))
