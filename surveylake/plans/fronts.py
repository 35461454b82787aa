"""The gold tables, in five fronts.

Every function takes the silver answers and returns one table. Answers are read
once and reduced by one aggregation that combines before its shuffle; shares,
ranks and steps are then taken from the aggregated rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from surveylake.operators import groups
from surveylake.operators.crosstab import crosstab, percent
from surveylake.operators.indicators import (
    diversity, index_vs_total, lift, rate_measures,
)
from surveylake.operators.quantiles import quantiles
from surveylake.operators.ranking import rank_within
from surveylake.operators.technology import explode_tech
from surveylake.operators.weights import count, count_if, kept, mean, total, weight
from surveylake.rules import TECH_CATEGORIES

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _rounded(df: DataFrame, cols: Sequence[str], places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


def _answered(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


# --- front 1: structure of the market and profile of the people --------------


def market_structure(silver: DataFrame) -> DataFrame:
    """Answers per role and edition, and their share of the edition."""
    counts = groups.summarise(silver, ["role", "edition"])
    whole = F.sum("n").over(Window.partitionBy("edition"))
    return counts.select("role", "edition", "n", percent(F.col("n"), whole).alias("pct"))


def profile(silver: DataFrame) -> DataFrame:
    """One-way tables of role, seniority, region and work model."""
    table = groups.one_way(silver, ["role", "seniority", "region", "work_model"])
    whole = F.sum("n").over(Window.partitionBy("dimension"))
    return table.select("dimension", "value", "n", percent(F.col("n"), whole).alias("pct"))


def role_seniority(silver: DataFrame) -> DataFrame:
    return crosstab(silver, "role", "seniority", answered_only=True)


def edition_change(silver: DataFrame) -> DataFrame:
    """Answers per role in every edition of the survey, against the edition before it; 0 where a role gave none."""
    counts = groups.summarise(_answered(silver, "edition"), ["role", "edition"])
    editions = counts.agg(F.sort_array(F.collect_set("edition")).alias("e")).scalar()  # as many as the survey has
    per_role = counts.groupBy("role").agg(F.map_from_entries(F.collect_list(F.struct("edition", "n"))).alias("of"))
    rows = per_role.select("role", "of", F.posexplode(editions).alias("i", "edition"))

    def answers(edition: Column) -> Column:
        return F.coalesce(F.try_element_at("of", edition), F.lit(0).cast("bigint"))

    before = F.when(F.col("i") > 0, answers(F.get(editions, F.col("i") - 1)))
    out = rows.select("role", "edition", answers(F.col("edition")).alias("n"), before.alias("before"))
    return out.select(
        "role", "edition", "n", "before",
        (F.col("n") - F.col("before")).alias("change"),
        percent(F.col("n") - F.col("before"), F.col("before")).alias("change_pct"),
    )


# --- front 2: pay, seniority and professional value --------------------------


def pay_seniority(silver: DataFrame, exact: bool = True) -> DataFrame:
    table = quantiles(silver, ["seniority"], "pay", QUARTILES, exact=exact)
    return _rounded(table, ["mean", *QUARTILES])


def pay_role_seniority(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Pay by role and seniority, with a subtotal per role and the total."""
    by = ["role", "seniority"]
    sets = [by, ["role"], []]
    table = quantiles(silver, by, "pay", QUARTILES, exact=exact, sets=sets)
    return _rounded(table, ["mean", *QUARTILES])


def pay_band_seniority(silver: DataFrame) -> DataFrame:
    return crosstab(_answered(silver, "pay"), "pay_band", "seniority", answered_only=True)


def pay_index(silver: DataFrame) -> DataFrame:
    return index_vs_total(silver, ["role", "seniority"], "pay")


def seniority_step(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Median pay per seniority, and the step from the seniority below."""
    by = ["seniority_rank", "seniority"]
    table = quantiles(_answered(silver, "seniority"), by, "pay", {"median": 0.5}, exact=exact)
    # at most as many rows as there are seniority labels
    below = F.lag("median").over(Window.orderBy("seniority_rank"))
    step = F.col("median") - F.col("below")
    return table.withColumn("below", below).select(
        *by, "n", F.round("median", 4).alias("median"),
        F.round(step, 4).alias("step"),
        F.round(F.try_divide(step * 100, F.col("below")), 4).alias("step_pct"),
    )


# --- front 3: diversity, location and work models ----------------------------


def location(silver: DataFrame) -> DataFrame:
    """Answers per region and state, with a subtotal per region and the total."""
    table = groups.rollup(silver, ["region", "state"])
    # not a filter: it would be pushed below the aggregate, and the answers read twice
    overall = table.agg(F.max(F.when(F.col("level") == 3, F.col("n")))).scalar()
    return table.withColumn("pct", percent(F.col("n"), overall))


def pay_state(silver: DataFrame, exact: bool = True) -> DataFrame:
    table = quantiles(silver, ["state"], "pay", QUARTILES, exact=exact)
    return _rounded(table, ["mean", *QUARTILES])


def seniority_region(silver: DataFrame) -> DataFrame:
    return crosstab(silver, "region", "seniority", answered_only=True)


def work_model_region(silver: DataFrame) -> DataFrame:
    return crosstab(silver, "region", "work_model", answered_only=True)


def work_model_role(silver: DataFrame) -> DataFrame:
    return crosstab(silver, "role", "work_model", answered_only=True)


def work_model_seniority(silver: DataFrame) -> DataFrame:
    return crosstab(silver, "seniority", "work_model", answered_only=True)


def region_diversity(silver: DataFrame, category: str = "role") -> DataFrame:
    return diversity(silver, "region", category)


def pay_region_model(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Median pay per region and work model, and the gap to the best work model."""
    by = ["region", "work_model"]
    table = quantiles(_answered(silver, "work_model"), by, "pay", {"median": 0.5}, exact=exact)
    best = F.max("median").over(Window.partitionBy("region"))
    gap = F.col("median") - F.col("best")
    return table.withColumn("best", best).select(
        *by, "n", F.round("median", 4).alias("median"), F.round("best", 4).alias("best"),
        F.round(gap, 4).alias("gap"),
        F.round(F.try_divide(gap * 100, F.col("best")), 4).alias("gap_pct"),
    )


# --- front 4: technology stack and maturity ----------------------------------


def _tech_counts(
    silver: DataFrame, by: Sequence[str] = (), min_n: int = 1,
    cols: Mapping[str, str] = TECH_CATEGORIES,
) -> DataFrame:
    """``by..., category, technology, n, base, pct``.

    The base is everybody of the group who answered the category.
    """
    by = list(by)
    counts = (
        explode_tech(silver, cols, keep=[*by, *kept(silver)], with_base=True)
        .groupBy(*by, "category", "technology")
        .agg(count(weight(silver)).alias("n"))
    )
    is_base = F.col("technology").isNull()
    base = F.max(F.when(is_base, F.col("n"))).over(Window.partitionBy(*by, "category"))
    return (
        counts.withColumn("base", base)
        .filter(~is_base & (F.col("base") >= min_n))
        .withColumn("pct", percent(F.col("n"), F.col("base")))
    )


def adoption(silver: DataFrame) -> DataFrame:
    return _tech_counts(silver)


def top_tech(silver: DataFrame, k: int = 3) -> DataFrame:
    return rank_within(_tech_counts(silver), ["category"], "technology", k)


def top_tech_region(silver: DataFrame, k: int = 3) -> DataFrame:
    counts = _tech_counts(silver, ["region"])
    return rank_within(counts, ["region", "category"], "technology", k)


def tech_seniority(silver: DataFrame) -> DataFrame:
    return _tech_counts(_answered(silver, "seniority"), ["seniority"])


def tech_role(silver: DataFrame) -> DataFrame:
    return _tech_counts(silver, ["role"])


def tech_work_model(silver: DataFrame) -> DataFrame:
    return _tech_counts(_answered(silver, "work_model"), ["work_model"])


def tech_state(silver: DataFrame) -> DataFrame:
    return _tech_counts(silver, ["state"])


def maturity(silver: DataFrame) -> DataFrame:
    """Technologies named, and categories answered, per seniority."""
    answered = [F.col(c).isNotNull().cast("int") for c in TECH_CATEGORIES]
    measures = {
        "mean_tools": F.round(mean(weight(silver), F.col("n_tools")), 4),
        "mean_categories": F.round(mean(weight(silver), sum(answered[1:], answered[0])), 4),
    }
    return groups.summarise(silver, ["seniority"], measures)


def tech_pairs(silver: DataFrame, min_n: int = 1) -> DataFrame:
    """Technologies named in the same answer: n, support and lift of each pair.

    The list of an answer is walked once per technology, and each step reads the
    rest of the list, so nothing of quadratic size is held; the pairs are counted
    in the same task, and one row per distinct pair and task is shuffled. A
    technology paired with itself gives its own count, and a leading entry, which
    every answer has and which is paired with itself only, gives the base. So the
    answers are read once.
    """
    names = F.concat(*[
        F.coalesce(
            F.transform(F.col(c), _prefixed(category)), F.array().cast("array<string>")
        )
        for c, category in TECH_CATEGORIES.items()
    ])
    length = F.when(F.col("at") == 0, 1).otherwise(F.size("names"))
    counts = (
        silver.select(F.sort_array(names).alias("names"), *kept(silver))
        .filter(F.size("names") > 0)
        .select(F.concat(F.array(F.lit("")), F.col("names")).alias("names"), *kept(silver))
        .select(F.posexplode("names").alias("at", "a"), "names", *kept(silver))
        .select("a", F.explode(F.slice("names", F.col("at") + 1, length)).alias("b"), *kept(silver))
        .groupBy("a", "b")
        .agg(count(weight(silver)).alias("n"))
    )
    base = counts.agg(F.max(F.when(F.col("a") == "", F.col("n")))).scalar()
    alone = F.when(F.col("a") == F.col("b"), F.col("n"))
    n = F.col("n").cast("double")
    return (
        counts.withColumns({
            "n_a": F.max(alone).over(Window.partitionBy("a")),
            "n_b": F.max(alone).over(Window.partitionBy("b")),
        })
        .filter((F.col("a") < F.col("b")) & (F.col("n") >= min_n))
        .select(
            "a", "b", "n",
            F.round(n / base, 4).alias("support"),
            F.round(n * base / F.col("n_a") / F.col("n_b"), 4).alias("lift"),
        )
    )


def _prefixed(category: str) -> Callable[[Column], Column]:
    return lambda t: F.concat(F.lit(f"{category}:"), t)


def pay_tech(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Pay of those who name a technology, against all who answered its category."""
    paid = explode_tech(silver, keep=["pay", *kept(silver)], with_base=True)
    by = ["category", "technology"]
    # groups without pay go after the counting: a filter on pay would be moved to the raw text, which would be parsed twice
    table = quantiles(paid, by, "pay", {"median": 0.5}, exact=exact).filter(F.col("n") > 0)
    is_base = F.col("technology").isNull()
    overall = F.max(F.when(is_base, F.col("mean"))).over(Window.partitionBy("category"))
    return table.withColumn("overall", overall).filter(~is_base).select(
        *by, "n", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"),
        percent(F.col("mean"), F.col("overall")).alias("index"),
    )


# --- front 5: AI use and opportunities ---------------------------------------


def ai_rate(silver: DataFrame) -> DataFrame:
    """AI use by role, seniority, region and work model, stacked."""
    dims = ["role", "seniority", "region", "work_model"]
    return groups.one_way(silver, dims, rate_measures("ai_use", weight(silver))).drop("n")


def ai_state(silver: DataFrame) -> DataFrame:
    return silver.groupBy("state").agg(*[c.alias(name) for name, c in rate_measures("ai_use", weight(silver)).items()])


def ai_pay(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Median pay with and without AI use, per seniority, and the gap."""
    by = ["seniority", "ai_use"]
    # as in pay_tech, pay is not filtered before the counting
    table = quantiles(_answered(silver, "ai_use"), by, "pay", {"median": 0.5}, exact=exact).filter(F.col("n") > 0)
    use = F.col("ai_use")
    wide = table.groupBy("seniority").agg(
        F.coalesce(F.max(F.when(use, F.col("n"))), F.lit(0)).alias("n_with"),
        F.coalesce(F.max(F.when(~use, F.col("n"))), F.lit(0)).alias("n_without"),
        F.max(F.when(use, F.col("median"))).alias("w"),
        F.max(F.when(~use, F.col("median"))).alias("wo"),
    )
    gap = F.col("w") - F.col("wo")
    return wide.select(
        "seniority", "n_with", "n_without",
        F.round("w", 4).alias("median_with"), F.round("wo", 4).alias("median_without"),
        F.round(gap, 4).alias("gap"),
        F.round(F.try_divide(gap * 100, F.col("wo")), 4).alias("gap_pct"),
    )


def ai_tech_lift(silver: DataFrame) -> DataFrame:
    """AI use by technology, in all four categories."""
    return lift(silver, "ai_use")


#: Ranges of scores that are ranked apart; scores are around 1.
RANGES = 1_000


def _range(score: Column) -> Column:
    """Number of a score's range, growing with the score; a missing score comes below all."""
    wide = F.greatest(F.lit(0.0), F.least(F.lit(float(RANGES - 1)), F.floor(score * (RANGES / 4)).cast("double")))
    return F.coalesce(wide.cast("int"), F.lit(-1))


def opportunity(silver: DataFrame, min_n: int = 1) -> DataFrame:
    """Segments with high pay and little AI use: pay index x (1 - AI rate), ranked."""
    by, w = ["role", "region", "seniority"], weight(silver)
    segments = groups.summarise(
        _answered(silver, "seniority"), by,
        {
            "paid": count(w, "pay"),
            "pay_sum": total(w, F.col("pay")),
            "ai_base": count(w, "ai_use"),
            "ai_hits": count_if(w, F.coalesce(F.col("ai_use"), F.lit(False))),
        },
    )
    overall = segments.agg(
        F.try_divide(F.sum("pay_sum").cast("double"), F.sum("paid")).alias("mean")
    ).scalar()
    index = F.try_divide(F.col("pay_sum").cast("double"), F.col("paid")) / overall
    ai = F.try_divide(F.col("ai_hits").cast("double"), F.col("ai_base"))
    score = F.round(index * (1 - ai), 6)
    scored = segments.filter(F.col("n") >= min_n).select(
        *by, "n",
        F.round(index * 100, 4).alias("pay_index"),
        F.round(ai, 4).alias("ai_rate"),
        score.alias("score"),
    )
    # a rank is the number of segments in better ranges plus the rank in its range,
    # so no task sorts all segments
    ranges = segments.filter(F.col("n") >= min_n).select(_range(score).alias("r")).groupBy("r").agg(F.count("*").alias("m"))
    sizes = ranges.agg(F.collect_list(F.struct("r", "m"))).scalar()  # at most RANGES + 1 entries
    better = F.aggregate(
        F.filter("_sizes", lambda x: x["r"] > F.col("_range")), F.lit(0).cast("bigint"), lambda so_far, x: so_far + x["m"])
    inside = F.rank().over(Window.partitionBy("_range").orderBy(F.desc_nulls_last("score")))
    placed = scored.withColumns({"_range": _range(F.col("score")), "_sizes": sizes})
    return placed.withColumn("place", (better + inside).cast("bigint")).drop("_range", "_sizes")


def indicators(silver: DataFrame) -> DataFrame:
    """Headline indicators per region, one row each: one aggregation of the answers, then stacked."""
    remote = (F.col("work_model") == "Remoto").cast("double")
    parts = {
        "mean_pay": (F.count("pay"), F.try_divide(F.sum("pay").cast("double"), F.count("pay"))),
        "ai_rate": (F.count("ai_use"), F.avg(F.col("ai_use").cast("double"))),
        "remote_rate": (F.count("work_model"), F.avg(remote)),
    }
    wide = silver.groupBy("region").agg(*[
        F.struct(F.lit(name).alias("indicator"), base.alias("base"), F.round(value, 4).alias("value")).alias(name)
        for name, (base, value) in parts.items()
    ])
    return wide.select("region", F.inline(F.array(*parts))).select("indicator", "region", "base", "value")


# --- all of them --------------------------------------------------------------

GOLD_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "f1_market_structure": market_structure,
    "f1_profile": profile,
    "f1_role_seniority": role_seniority,
    "f1_edition_change": edition_change,
    "f2_pay_seniority": pay_seniority,
    "f2_pay_role_seniority": pay_role_seniority,
    "f2_pay_band_seniority": pay_band_seniority,
    "f2_pay_index": pay_index,
    "f2_seniority_step": seniority_step,
    "f3_location": location,
    "f3_work_model_region": work_model_region,
    "f3_work_model_role": work_model_role,
    "f3_work_model_seniority": work_model_seniority,
    "f3_diversity": region_diversity,
    "f3_pay_region_model": pay_region_model,
    "f3_pay_state": pay_state,
    "f3_seniority_region": seniority_region,
    "f4_adoption": adoption,
    "f4_top_tech": top_tech,
    "f4_top_tech_region": top_tech_region,
    "f4_tech_seniority": tech_seniority,
    "f4_tech_role": tech_role,
    "f4_tech_work_model": tech_work_model,
    "f4_tech_state": tech_state,
    "f4_maturity": maturity,
    "f4_tech_pairs": tech_pairs,
    "f4_pay_tech": pay_tech,
    "f5_ai_rate": ai_rate,
    "f5_ai_state": ai_state,
    "f5_ai_pay": ai_pay,
    "f5_ai_tech_lift": ai_tech_lift,
    "f5_opportunity": opportunity,
}

_TECH = tuple(TECH_CATEGORIES)

#: Questions each gold table reads.
GOLD_COLUMNS: dict[str, tuple[str, ...]] = {
    "f1_market_structure": ("role", "edition"),
    "f1_profile": ("role", "seniority", "region", "work_model"),
    "f1_role_seniority": ("role", "seniority"),
    "f1_edition_change": ("role", "edition"),
    "f2_pay_seniority": ("seniority", "pay"),
    "f2_pay_role_seniority": ("role", "seniority", "pay"),
    "f2_pay_band_seniority": ("pay", "pay_band", "seniority"),
    "f2_pay_index": ("role", "seniority", "pay"),
    "f2_seniority_step": ("seniority", "seniority_rank", "pay"),
    "f3_location": ("region", "state"),
    "f3_work_model_region": ("region", "work_model"),
    "f3_work_model_role": ("role", "work_model"),
    "f3_work_model_seniority": ("seniority", "work_model"),
    "f3_diversity": ("region", "role"),
    "f3_pay_region_model": ("region", "work_model", "pay"),
    "f3_pay_state": ("state", "pay"),
    "f3_seniority_region": ("region", "seniority"),
    "f4_adoption": _TECH,
    "f4_top_tech": _TECH,
    "f4_top_tech_region": ("region", *_TECH),
    "f4_tech_seniority": ("seniority", *_TECH),
    "f4_tech_role": ("role", *_TECH),
    "f4_tech_work_model": ("work_model", *_TECH),
    "f4_tech_state": ("state", *_TECH),
    "f4_maturity": ("seniority", "n_tools", *_TECH),
    "f4_tech_pairs": _TECH,
    "f4_pay_tech": ("pay", *_TECH),
    "f5_ai_rate": ("role", "seniority", "region", "work_model", "ai_use"),
    "f5_ai_state": ("state", "ai_use"),
    "f5_ai_pay": ("seniority", "ai_use", "pay"),
    "f5_ai_tech_lift": ("ai_use", "langs", "bi_tools", "databases", "clouds"),
    "f5_opportunity": ("role", "region", "seniority", "pay", "ai_use"),
}
