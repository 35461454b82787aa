"""Many-choice answers: text to array, arrays to one row per technology."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from surveylake.rules import TECH_CATEGORIES


def explode_tech(
    df: DataFrame,
    cols: Mapping[str, str] = TECH_CATEGORIES,
    keep: Sequence[str] = ("resp_id",),
    with_base: bool = False,
) -> DataFrame:
    """``keep..., category, technology``: one row per technology of an answer.

    The arrays hold no repeats and a row is one answer, so the result is distinct
    without a shuffle. With ``with_base`` every answered category also gives a
    row whose technology is NULL: counting rows per category and technology then
    gives the answered base together with the uses, in one aggregation.
    """
    def listed(col: str, category: str) -> Column:
        items = F.col(col)
        if with_base:
            items = F.array_append(items, F.lit(None).cast("string"))
        return F.struct(F.lit(category).alias("category"), items.alias("items"))

    # first a row per category, then a row per technology: both are plain
    # generators, and a list that is NULL gives no row
    lists = F.array(*[listed(col, category) for col, category in cols.items()])
    return df.select(*keep, F.inline(lists)).select(
        *keep, "category", F.explode("items").alias("technology")
    )
