"""Putting silver tables, and indicator tables, together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _users(tech: DataFrame, category: str, technology: str) -> DataFrame:
    chosen = (F.col("category") == category) & (F.col("technology") == technology)
    return tech.filter(chosen).select("resp_id")


def using(answers: DataFrame, tech: DataFrame, category: str, technology: str) -> DataFrame:
    """Answers that name the technology."""
    return answers.join(_users(tech, category, technology), "resp_id", "left_semi")


def not_using(answers: DataFrame, tech: DataFrame, category: str, technology: str) -> DataFrame:
    """Answers that do not name it, whether or not they answered the question."""
    return answers.join(_users(tech, category, technology), "resp_id", "left_anti")


def with_technologies(answers: DataFrame, tech: DataFrame, how: str = "inner") -> DataFrame:
    """Answers with a row per technology they name; ``left`` keeps those that name none, with NULL."""
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    return answers.join(tech.select("resp_id", "category", "technology"), "resp_id", how)


def union_indicators(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column missing in one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
