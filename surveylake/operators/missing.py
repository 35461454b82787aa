"""Missing values: to NULL, reported, filled or dropped."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from surveylake.functions import is_missing_word
from surveylake.operators.lookups import join_group_values
from surveylake.operators.quantiles import quantiles
from surveylake.rules import MISSING_WORDS


def null_sentinels(
    df: DataFrame, cols: Sequence[str], sentinels: Iterable[str] = MISSING_WORDS
) -> DataFrame:
    words = tuple(sentinels)
    return df.withColumns({c: F.when(~is_missing_word(c, words), F.col(c)) for c in cols})


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, NULLs and share of NULLs per column, in one pass over the data."""
    cols = list(cols or df.columns)
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    return counts.unpivot("rows", cols, "column", "missing").select(
        "column", "rows", "missing",
        F.round(F.try_divide(F.col("missing").cast("double"), F.col("rows")), 4).alias("share"),
    )


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def drop_missing(df: DataFrame, cols: Sequence[str], how: str = "any") -> DataFrame:
    return df.dropna(how=how, subset=list(cols))


def impute(df: DataFrame, col: str, by: Sequence[str], how: str = "median") -> DataFrame:
    """Fill NULLs of ``col`` with the median or the mode of their group.

    The result is in ``<col>_filled``, and ``col`` stays as it was: an imputed
    value must never reach pay statistics by accident. Ties of the mode go to
    the smallest value.
    """
    by, stat = list(by), f"_{col}_{how}"
    if how == "median":
        values = quantiles(df, by, col, {stat: 0.5}).select(*by, stat)
    elif how == "mode":
        counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("_n"))
        values = counts.groupBy(*by).agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(stat))
    else:
        raise ValueError(f"how must be 'median' or 'mode', not {how!r}")
    filled = F.coalesce(F.col(col).cast("double") if how == "median" else F.col(col), F.col(stat))
    return (
        join_group_values(df, values, by)
        .withColumn(f"{col}_filled", filled)
        .drop(stat)
    )
