"""Counting answers, or rows that stand for many answers.

A row of stored counts carries in ``_weight`` how many answers it stands for. The
analysis counts through these functions, so the same code takes answers, which have no
such column, and counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WEIGHT = "_weight"


def weight(df: DataFrame) -> Column | None:
    return F.col(WEIGHT) if WEIGHT in df.columns else None


def kept(df: DataFrame) -> list[str]:
    """The weight, for a selection that must not lose it."""
    return [WEIGHT] if WEIGHT in df.columns else []


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def count(w: Column | None, c: Column | str | None = None) -> Column:
    """Answers, or those that have ``c``."""
    if w is None:
        return F.count("*" if c is None else c)
    return _sum(w if c is None else F.when((F.col(c) if isinstance(c, str) else c).isNotNull(), w))


def count_if(w: Column | None, c: Column) -> Column:
    return F.count_if(c) if w is None else _sum(F.when(c, w))


def total(w: Column | None, c: Column) -> Column:
    """Sum of a number over the answers."""
    return F.sum(c) if w is None else F.sum(c * w)


def mean(w: Column | None, c: Column) -> Column:
    """Mean of a number over the answers that have it, as a double."""
    if w is None:
        return F.avg(c.cast("double"))
    return F.try_divide(F.sum(c.cast("double") * w), F.sum(F.when(c.isNotNull(), w)))


def counted(df: DataFrame, by: list[str]) -> DataFrame:
    """The answers as distinct values of ``by``, each with the number of answers that have them."""
    return df.groupBy(*by).agg(count(weight(df)).alias(WEIGHT))
