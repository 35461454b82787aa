"""Indicators: rates, indices, strength of a crossing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from surveylake.operators.crosstab import pair_counts, percent
from surveylake.rules import TECH_CATEGORIES
from surveylake.operators.technology import explode_tech
from surveylake.operators.weights import count, count_if, kept, mean, total, weight


def rate_measures(flag: str, w: Column | None = None) -> dict[str, Column]:
    """``w`` is the weight of the rows, if they stand for several answers."""
    c = F.col(flag)
    return {
        "base": count(w, c),
        "hits": count_if(w, F.coalesce(c, F.lit(False))),
        "rate": F.round(mean(w, c.cast("double")), 4),
    }


def rate(df: DataFrame, by: Sequence[str], flag: str, min_n: int = 0) -> DataFrame:
    """Share of true among those who answered, with that base; a group nobody answered for has base 0."""
    out = df.groupBy(*by).agg(*[c.alias(name) for name, c in rate_measures(flag, weight(df)).items()])
    return out.filter(F.col("base") >= min_n) if min_n > 0 else out


def index_vs_total(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Mean per group, and that mean as a percentage of the overall mean.

    The overall mean comes from the sums of the groups, so the answers are read
    once; a group without values stays, with NULL.
    """
    w = weight(df)
    sums = df.groupBy(*by).agg(count(w, col).alias("n"), total(w, F.col(col)).alias("_sum"))
    whole = sums.agg(
        F.try_divide(F.sum("_sum").cast("double"), F.sum("n")).alias("mean")
    ).scalar()
    average = F.try_divide(F.col("_sum").cast("double"), F.col("n"))
    return sums.select(
        *by, "n", F.round(average, 4).alias("mean"), percent(average, whole).alias("index"),
        F.round(average - whole, 4).alias("gap"),
    )


def association(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cramér's V of two categories over answers to both: n, chi2, v."""
    counts = pair_counts(df, a, b, answered_only=True)
    n = F.col("n").cast("double")
    cells = counts.select(
        a, b, "n",
        (n * n / F.sum("n").over(Window.partitionBy(a)) / F.sum("n").over(Window.partitionBy(b))).alias("part"),
    )
    sums = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("part").alias("s"),
        (F.least(F.count_distinct(a), F.count_distinct(b)) - 1).alias("df"),
    )
    chi2 = F.greatest(F.col("n") * (F.col("s") - 1), F.lit(0.0))
    return sums.select(
        "n",
        F.round(chi2, 4).alias("chi2"),
        F.round(F.sqrt(F.try_divide(chi2, F.col("n") * F.col("df"))), 4).alias("v"),
    )


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation and sample covariance over answers that have both."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return both.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.round(F.corr(a, b), 6).alias("corr"),
        F.round(F.covar_samp(a, b), 2).alias("covar"),
    )


def lift(
    df: DataFrame,
    flag: str,
    cols: Mapping[str, str] = TECH_CATEGORIES,
    min_n: int = 1,
) -> DataFrame:
    """How much more often ``flag`` is true with a technology than in its category.

    The base of a category is everybody who answered both the category and the
    flag; it is counted in the same aggregation as the technologies.
    """
    answered = df.filter(F.col(flag).isNotNull())
    w = weight(df)
    counts = (
        explode_tech(answered, cols, keep=[flag, *kept(df)], with_base=True)
        .groupBy("category", "technology")
        .agg(count(w).alias("n"), count_if(w, F.col(flag)).alias("hits"))
    )
    whole = Window.partitionBy("category")
    base = F.col("technology").isNull()
    share = F.col("hits") / F.col("n")
    overall = F.max(F.when(base, share)).over(whole)
    return (
        counts.select(
            "category", "technology", "n", "hits",
            F.max(F.when(base, F.col("n"))).over(whole).alias("base"),
            F.round(share, 4).alias("rate"),
            F.round(F.try_divide(share, overall), 4).alias("lift"),
        )
        .filter(~base & (F.col("n") >= min_n))
    )


def diversity(df: DataFrame, group: str, category: str) -> DataFrame:
    """How spread a category is within a group: entropy, evenness, Simpson index.

    With N answers of which n_i fall on label i, the entropy is
    ln N - sum(n_i ln n_i) / N and the Simpson index 1 - sum(n_i^2) / N^2, so
    one more aggregation over the counted pairs is all that is needed.
    """
    counts = pair_counts(df.filter(F.col(category).isNotNull()), group, category)
    n = F.col("n").cast("double")
    sums = counts.groupBy(group).agg(
        F.sum("n").alias("n"),
        F.count("*").alias("labels"),
        F.sum(n * F.ln(n)).alias("_nlogn"),
        F.sum(n * n).alias("_nn"),
    )
    entropy = F.ln(n) - F.col("_nlogn") / n
    return sums.select(
        group, "n", "labels",
        F.round(F.abs(entropy), 4).alias("entropy"),
        F.round(F.when(F.col("labels") > 1, entropy / F.ln(F.col("labels"))), 4).alias("evenness"),
        F.round(1 - F.col("_nn") / (n * n), 4).alias("simpson"),
    )
