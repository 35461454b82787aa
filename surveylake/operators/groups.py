"""Grouping and aggregating answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from surveylake.operators.weights import count, count_if, weight

#: Columns of an exact profile that one pass counts; Spark takes up to 64 in grouping sets.
PROFILED = 32


def number_stats(col: str) -> dict[str, Column]:
    """Count, sum, mean, spread, least and greatest of a number, as doubles."""
    c = F.col(col)
    return {
        f"{col}_n": F.count(c),
        f"{col}_sum": F.sum(c).cast("double"),
        f"{col}_mean": F.try_divide(F.sum(c).cast("double"), F.count(c)),
        f"{col}_std": F.stddev_samp(c.cast("double")),
        f"{col}_min": F.min(c).cast("double"),
        f"{col}_max": F.max(c).cast("double"),
    }


def _measures(
    df: DataFrame, measures: Mapping[str, Column] | None, distinct: str | None, exact: bool = True
) -> list[Column]:
    out = [count(weight(df)).alias("n")]
    if distinct:
        different = F.count_distinct if exact else F.approx_count_distinct
        out.append(different(F.col(distinct)).alias(f"{distinct}_distinct"))
    return out + [c.alias(name) for name, c in (measures or {}).items()]


def summarise(
    df: DataFrame,
    by: Sequence[str],
    measures: Mapping[str, Column] | None = None,
    distinct: str | None = None,
    min_n: int = 1,
    exact: bool = True,
) -> DataFrame:
    """Rows per group and the given aggregates; groups under ``min_n`` are hidden.

    ``exact=False`` estimates the distinct values, with a state of fixed size per group.
    """
    out = df.groupBy(*by).agg(*_measures(df, measures, distinct, exact))
    return out.filter(F.col("n") >= min_n) if min_n > 1 else out


def multi_group(
    df: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """Several groupings in one pass; ``level`` is the grouping id."""
    by = list(dict.fromkeys(c for s in sets for c in s))
    out = df.groupingSets([list(s) for s in sets], *by)
    return out.agg(F.grouping_id().alias("level"), *_measures(df, measures, None)).select(
        "level", *by, "n", *(measures or {})
    )


def rollup(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column] | None = None) -> DataFrame:
    out = df.rollup(*by).agg(F.grouping_id().alias("level"), *_measures(df, measures, None))
    return out.select("level", *by, "n", *(measures or {}))


def cube(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column] | None = None) -> DataFrame:
    out = df.cube(*by).agg(F.grouping_id().alias("level"), *_measures(df, measures, None))
    return out.select("level", *by, "n", *(measures or {}))


def one_way(
    df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """``dimension, value, n, ...``: a table per dimension, stacked, in one pass."""
    grouped = multi_group(df, [[d] for d in dims], measures)
    full = (1 << len(dims)) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dims):
        here = F.col("level") == (full & ~(1 << (len(dims) - 1 - i)))
        name = F.when(here, F.lit(d)).otherwise(name)
        value = F.when(here, F.col(d).cast("string")).otherwise(value)
    return grouped.select(
        name.alias("dimension"), value.alias("value"), "n", *(measures or {})
    )


def _counted_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``profile`` from the counted values of every column."""
    own = [f"c{i}" for i in range(len(cols))]
    counted = multi_group(df.select(*[F.col(c).alias(o) for c, o in zip(cols, own)]), [[o] for o in own])
    full, n = (1 << len(own)) - 1, F.col("n")
    per_column = []
    for i, o in enumerate(own):
        here = F.col("level") == (full & ~(1 << (len(own) - 1 - i)))
        per_column.append(F.struct(
            count_if(n, here).alias("rows"),
            count_if(n, here & F.col(o).isNull()).alias("nulls"),
            F.count(o).alias("distinct_values"),  # NULL in the rows of other columns
            F.min(o).cast("string").alias("least"),
            F.max(o).cast("string").alias("greatest"),
        ).alias(cols[i]))
    return counted.agg(*per_column).unpivot([], list(cols), "column", "s").select("column", "s.*")


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Per column: rows, NULLs, distinct values, least and greatest value as text.

    Distinct values are estimated, so a table of any width is profiled in one
    pass without a shuffle of its rows; ``exact=True`` counts the rows of every value of
    every column, ``PROFILED`` columns in a pass, which shuffles the distinct values.
    """
    cols = list(cols or df.columns)
    if exact:
        parts = [_counted_profile(df, cols[i:i + PROFILED]) for i in range(0, len(cols), PROFILED)]
        return reduce(DataFrame.union, parts)
    per_column = {
        c: F.struct(
            F.count("*").alias("rows"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.approx_count_distinct(F.col(c)).alias("distinct_values"),
            F.min(F.col(c)).cast("string").alias("least"),
            F.max(F.col(c)).cast("string").alias("greatest"),
        )
        for c in cols
    }
    row = df.agg(*[s.alias(c) for c, s in per_column.items()])
    return row.unpivot([], cols, "column", "s").select("column", "s.*")
