"""Choosing and renaming variables, auxiliary columns, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from surveylake.operators.lookups import join_group_values
from surveylake.operators.quantiles import quantiles


def organise(df: DataFrame, spec: Mapping[str, str | Column]) -> DataFrame:
    """``{new name: old name or expression}``, in the order wanted."""
    # a name is quoted, because raw headers hold dots, blanks and brackets
    cols = {
        new: F.col(f"`{old}`") if isinstance(old, str) else old for new, old in spec.items()
    }
    return df.select(*[c.alias(new) for new, c in cols.items()])


def band(c: Column, edges: Sequence, labels: Sequence[str], missing: str | None = None) -> Column:
    """``labels[0]`` below the first edge, ``labels[i]`` from edge i on."""
    if len(labels) != len(edges) + 1:
        raise ValueError("there is one label more than edges")
    if list(edges) != sorted(edges):
        raise ValueError("edges must grow")
    out = F.when(c.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels):
        out = out.when(c < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def add_band(
    df: DataFrame, col: str, edges: Sequence, labels: Sequence[str],
    name: str | None = None, missing: str | None = None,
) -> DataFrame:
    return df.withColumn(name or f"{col}_band", band(F.col(col), edges, labels, missing))


def add_aux(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Flags, ranks, sizes, date parts: any built-in expression, by name."""
    return df.withColumns(dict(exprs))


def add_quantile_band(
    df: DataFrame, col: str, by: Sequence[str], n: int, name: str | None = None
) -> DataFrame:
    """Group 1..n of a number within its group, cut at the group's quantiles.

    A value equal to a cut belongs to the lower group; NULL stays NULL.
    """
    by = list(by)
    cuts = {f"_cut{i}": i / n for i in range(1, n)}
    edges = quantiles(df, by, col, cuts).select(*by, *cuts)
    joined = join_group_values(df, edges, by)
    number = F.col(col).cast("double")
    above = [F.when(number > F.col(c), 1).otherwise(0) for c in cuts]
    group = F.lit(1)
    for step in above:
        group = group + step
    return joined.withColumn(
        name or f"{col}_group", F.when(number.isNotNull(), group)
    ).drop(*cuts)
