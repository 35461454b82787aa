"""Replacing a value and remembering that it was rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ISSUES = "issues"


def no_issues(df: DataFrame) -> DataFrame:
    if ISSUES in df.columns:
        return df
    return df.withColumn(ISSUES, F.array().cast("array<string>"))


def replace_value(df: DataFrame, col: str, value: Column, rejected: Column) -> DataFrame:
    """Set ``col`` to ``value`` and add its name to ``issues`` where ``rejected``."""
    df = no_issues(df)
    noted = F.when(rejected, F.array_append(ISSUES, F.lit(col))).otherwise(F.col(ISSUES))
    return df.withColumns({col: value, ISSUES: noted})


def convert(df: DataFrame, col: str, value: Column) -> DataFrame:
    """Set ``col`` to ``value``; a value present before and NULL after is an issue."""
    # the new value comes first: it is always needed, so it is computed only once
    return replace_value(df, col, value, value.isNull() & F.col(col).isNotNull())


def issue_report(df: DataFrame) -> DataFrame:
    """Rejected values per column."""
    return df.select(F.explode(ISSUES).alias("column")).groupBy("column").agg(F.count("*").alias("n"))
