"""One query per operator: (spark, folder of the tables) -> DataFrame.

Results hold text, bigint, double and boolean only: dates and lists are written
as text and decimals as doubles, so that two engines can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from surveylake.checks.survey import survey_batches, survey_raw, survey_silver, survey_tech, table
from surveylake.functions import join_list, split_list, text_key, to_flag, to_int, to_money
from surveylake.operators import groups, indicators
from surveylake.operators.category import map_category, unmapped
from surveylake.operators.combine import not_using, using, with_technologies
from surveylake.operators.crosstab import crosstab, crosstab_wide
from surveylake.operators.derive import add_aux, add_band, add_quantile_band, organise
from surveylake.operators.invalid import check_domain, check_range, quarantine_report
from surveylake.operators.issues import issue_report
from surveylake.operators.missing import (
    drop_missing, fill_missing, impute, missing_report, null_sentinels,
)
from surveylake.operators.quantiles import quantiles
from surveylake.operators.ranking import top_k
from surveylake.operators.sketches import compared, distinct_sketches
from surveylake.operators.typed import enforce_schema, to_date_fmt, to_decimal_br
from surveylake.plans import fronts
from surveylake.plans.silver import build_silver, latest_answers
from surveylake.rules import (
    NO_PAY, PAY_EDGES, PAY_LABELS, RAW_COLUMNS, SENIORITY, SILVER_SCHEMA, TECH_CATEGORIES, WORK_MODEL,
)
from surveylake.sources.raw import trace
from surveylake.sources.catalog import sql

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Dates and lists as text, decimals as doubles, whole numbers as bigint."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("array"):
            c = join_list(c)
        elif kind.startswith("decimal") or kind == "float":
            c = c.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind == "date":
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)


# --- bronze and silver --------------------------------------------------------


def bronze_scan(spark, sf):
    return survey_raw(spark, sf)


def silver_trace(spark, sf):
    bronze = survey_batches(spark, sf, ["resp_id", "pay", "seniority"])
    kept, _ = latest_answers(bronze)
    silver = build_silver(kept).select("resp_id", "_batch_id", "_row_id", "pay", "seniority")
    return trace(silver, bronze)


def silver_missing_sentinels(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "seniority", "pay", "langs"])
    return null_sentinels(raw, ["seniority", "pay", "langs"])


def silver_missing_report(spark, sf):
    raw = survey_raw(spark, sf)
    return missing_report(null_sentinels(raw, RAW_COLUMNS))


def silver_fill_constant(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "seniority", "work_model", "seniority_rank"])
    return fill_missing(silver, {"seniority": "sem resposta", "work_model": "?", "seniority_rank": 0})


def silver_drop_missing(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "seniority", "work_model", "pay"])
    return drop_missing(silver, ["pay", "work_model"], "any")


def silver_impute_median(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "seniority", "pay"])
    return impute(silver, "pay", ["seniority"], "median").withColumn(
        "pay_filled", F.round("pay_filled", 4)
    )


def silver_impute_mode(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "region", "work_model"])
    return impute(silver, "work_model", ["region"], "mode")


def silver_types_int_bool(spark, sf):
    raw = survey_batches(spark, sf, ["resp_id", "ai_use"])
    return raw.select(
        "_batch_id", F.col("resp_id").alias("raw_id"), to_int("resp_id").alias("resp_id"),
        F.col("ai_use").alias("raw_ai_use"), to_flag("ai_use").alias("ai_use"),
    )


def silver_types_money(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "pay"])
    return to_decimal_br(raw.withColumn("raw_pay", F.col("pay")), "pay")


def silver_types_date(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "answered_at"])
    return to_date_fmt(raw.withColumn("raw_date", F.col("answered_at")), "answered_at")


def silver_invalid_range(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "pay"])
    return check_range(raw.withColumn("pay", to_money("pay")), "pay", 0, 400_000, lo_open=True)


def silver_clamp(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "pay"])
    return check_range(silver, "pay", 5_000, 400_000, action="clamp")


def silver_invalid_domain(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "work_model", "answered_at"])
    raw = raw.withColumn("work_model", text_key("work_model"))
    raw = check_domain(raw, "work_model", list(WORK_MODEL))
    return check_domain(raw, "answered_at", regex=r"^[0-9]{2}/[0-9]{2}/(199[5-9]|200[01])$")


def silver_issue_report(spark, sf):
    return issue_report(survey_silver(spark, sf, ["issues"]))


def silver_quarantine(spark, sf):
    batches = survey_batches(spark, sf, ["resp_id", "pay"])
    return quarantine_report(batches, ["resp_id"], ["pay"])


def silver_text_key(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "seniority", "work_model"])
    return raw.select(
        "resp_id", text_key("seniority").alias("seniority_key"),
        text_key("work_model").alias("work_model_key"),
    )


def silver_category_map(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "seniority"]).withColumn("raw", F.col("seniority"))
    return map_category(null_sentinels(raw, ["seniority"]), "seniority", SENIORITY, "seniority_rank")


def silver_unmapped(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "work_model"])
    return unmapped(raw, "work_model", WORK_MODEL)


def silver_organise(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "role", "region", "state"])
    return organise(raw, {
        "uf": "state", "regiao": "region", "cargo": "role",
        "chave": F.concat(F.lit("r"), F.col("resp_id")),
    })


def silver_pay_band(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "pay"])
    return add_band(silver, "pay", PAY_EDGES, PAY_LABELS, "pay_band", NO_PAY)


def silver_aux_columns(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "answered_at", "seniority", "langs"])
    return add_aux(silver, {
        "edition": F.year("answered_at"),
        "month": F.date_format("answered_at", "yyyy-MM"),
        "has_seniority": F.col("seniority").isNotNull(),
        "n_langs": F.coalesce(F.array_size("langs"), F.lit(0)),
    })


def silver_quantile_band(spark, sf):
    silver = survey_silver(spark, sf, ["resp_id", "seniority", "pay"])
    return add_quantile_band(silver, "pay", ["seniority"], 4)


def silver_multi_split(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "langs"])
    return raw.select("resp_id", split_list("langs").alias("langs"))


def silver_tech_long(spark, sf):
    return survey_tech(spark, sf)


def silver_dedupe(spark, sf):
    batches = survey_batches(spark, sf, ["resp_id", "pay", "seniority"])
    kept, _ = latest_answers(batches)
    return kept


def silver_survey(spark, sf):
    return survey_silver(spark, sf)


def catalog_profile(spark, sf):
    cols = ["seniority", "pay", "work_model", "ai_use", "answered_at", "n_tools"]
    return groups.profile(survey_silver(spark, sf, cols), exact=True)


def sql_view_query(spark, sf):
    silver = survey_silver(spark, sf, ["work_model", "seniority", "pay"])
    return sql(
        spark,
        """
        SELECT work_model, seniority, count(*) AS n, CAST(max(pay) AS DOUBLE) AS max_pay
        FROM {silver_answers} WHERE seniority IS NOT NULL
        GROUP BY work_model, seniority HAVING count(*) > 1
        """,
        views={"silver_answers": silver},
    )


# --- gold: general operators --------------------------------------------------


def gold_filter(spark, sf):
    cols = ["resp_id", "role", "work_model", "seniority", "pay"]
    return survey_silver(spark, sf, cols).filter(
        F.col("pay").between(150_000, 250_000)
        & F.col("work_model").isin("Remoto", "Híbrido")
        & F.col("seniority").isNotNull()
        & F.col("role").like("%E%")
        & (F.col("pay") != 200_000)
    )


def gold_group(spark, sf):
    cols = ["role", "work_model", "seniority"]
    return groups.summarise(survey_silver(spark, sf, cols), cols, min_n=5)


def gold_aggregates(spark, sf):
    silver = survey_silver(spark, sf, ["role", "pay"])
    stats = groups.number_stats("pay")
    table = groups.summarise(silver, ["role"], stats)
    return table.withColumns({
        "pay_mean": F.round("pay_mean", 4), "pay_std": F.round("pay_std", 4),
        "pay_sum": F.round("pay_sum", 2),
    })


def gold_quantiles(spark, sf):
    silver = survey_silver(spark, sf, ["work_model", "seniority", "pay"])
    ps = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    table = quantiles(silver, ["work_model", "seniority"], "pay", ps)
    return table.withColumns({c: F.round(c, 4) for c in ["mean", *ps]})


def gold_quantiles_double(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") * (F.lit(1.0) - (F.col("o_orderkey") % 16) / 64)).alias("paid"))
    by, ps = ["o_orderstatus", "o_orderpriority"], {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    found = quantiles(orders, by, "paid", ps, sets=[by, by[:1], []])
    return found.withColumns({c: F.round(c, 4) for c in ["mean", *ps]})


def gold_quantiles_bigint(spark, sf):
    """Numbers of both signs, spread over some 2**45 units."""
    signed = F.when(F.col("o_orderkey") % 3 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")) * 6_700_417
    orders = table(spark, sf, "orders").select("o_orderstatus", signed.alias("code"))
    ps = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p100": 1.0}
    found = quantiles(orders, ["o_orderstatus"], "code", ps)
    return found.withColumns({c: F.round(c, 4) for c in ["mean", *ps]})


def gold_distinct(spark, sf):
    silver = survey_silver(spark, sf, ["region", "state"])
    return groups.summarise(silver, ["region"], distinct="state")


def gold_distinct_sketches(spark, sf):
    """Distinct values over all editions, and of two editions against each other, from one sketch per edition."""
    silver = survey_silver(spark, sf, ["edition", "role", "region", "state", "seniority"])
    kept = distinct_sketches(silver, ["edition"], ["role", "region", "state", "seniority"])
    e = F.col("edition")
    return compared(kept, e <= 1994, e >= 1994)


def gold_crosstab(spark, sf):
    silver = survey_silver(spark, sf, ["seniority", "work_model"])
    return crosstab(silver, "seniority", "work_model")


def gold_crosstab_wide(spark, sf):
    silver = survey_silver(spark, sf, ["seniority", "work_model"])
    table = crosstab_wide(silver, "seniority", "work_model", list(WORK_MODEL.values()))
    return table.withColumnsRenamed({"Presencial": "presencial", "Híbrido": "hibrido", "Remoto": "remoto"})


def _paid():
    return {"paid": F.count("pay"), "pay_sum": F.sum("pay").cast("double")}


def gold_grouping_sets(spark, sf):
    silver = survey_silver(spark, sf, ["seniority", "work_model", "pay"])
    return groups.multi_group(silver, [["seniority"], ["work_model"], []], _paid())


def gold_rollup(spark, sf):
    silver = survey_silver(spark, sf, ["region", "work_model", "pay"])
    return groups.rollup(silver, ["region", "work_model"], _paid())


def gold_cube(spark, sf):
    silver = survey_silver(spark, sf, ["seniority", "work_model", "pay"])
    return groups.cube(silver, ["seniority", "work_model"], _paid())


def gold_rate(spark, sf):
    silver = survey_silver(spark, sf, ["role", "seniority", "ai_use"])
    return indicators.rate(silver, ["role", "seniority"], "ai_use", min_n=5)


def gold_index(spark, sf):
    return indicators.index_vs_total(survey_silver(spark, sf, ["region", "pay"]), ["region"], "pay")


def gold_cramers_v(spark, sf):
    silver = survey_silver(spark, sf, ["seniority", "work_model"])
    return indicators.association(silver, "seniority", "work_model")


def gold_correlation(spark, sf):
    silver = survey_silver(spark, sf, ["seniority", "pay", "n_tools"])
    return indicators.correlation(silver, "pay", "n_tools", ["seniority"])


def gold_lift(spark, sf):
    silver = survey_silver(spark, sf, ["ai_use", "bi_tools", "databases"])
    return indicators.lift(silver, "ai_use", {"bi_tools": "bi", "databases": "db"})


def gold_top_k(spark, sf):
    return top_k(survey_tech(spark, sf), [], "technology", 10)


def gold_top_k_per_group(spark, sf):
    return top_k(survey_tech(spark, sf), ["category"], "technology", 5)


def gold_join_semi(spark, sf):
    answers = survey_silver(spark, sf, ["resp_id", "role", "work_model"])
    return using(answers, survey_tech(spark, sf), "lang", "PROMO")


def gold_join_anti(spark, sf):
    answers = survey_silver(spark, sf, ["resp_id", "role", "work_model"])
    return not_using(answers, survey_tech(spark, sf), "db", "BLUE")


def gold_join_inner(spark, sf):
    answers = survey_silver(spark, sf, ["resp_id", "role", "work_model"])
    return with_technologies(answers, survey_tech(spark, sf))


def gold_join_left(spark, sf):
    answers = survey_silver(spark, sf, ["resp_id", "role"])
    tech = survey_tech(spark, sf).filter(F.col("category") == "lang")
    return with_technologies(answers, tech, "left")


def silver_schema_contract(spark, sf):
    raw = survey_raw(spark, sf, ["resp_id", "role", "answered_at"]).withColumn("seniority_rank", F.lit(" 2 "))
    contract = T.StructType([f for f in SILVER_SCHEMA if f.name in ("resp_id", "role", "seniority_rank")])
    return enforce_schema(raw, contract)


def gold_indicator_union(spark, sf):
    return fronts.indicators(survey_silver(spark, sf, ["region", "pay", "ai_use", "work_model"]))


# --- gold: fronts -------------------------------------------------------------

def _front(name: str) -> Query:
    build, columns = fronts.GOLD_TABLES[name], fronts.GOLD_COLUMNS[name]
    return lambda spark, sf: build(survey_silver(spark, sf, columns))


_OPERATORS = (
    bronze_scan, silver_trace, silver_missing_sentinels, silver_missing_report,
    silver_fill_constant, silver_drop_missing, silver_impute_median, silver_impute_mode,
    silver_types_int_bool, silver_types_money, silver_types_date, silver_invalid_range,
    silver_clamp, silver_invalid_domain, silver_issue_report, silver_quarantine,
    silver_text_key, silver_category_map, silver_unmapped, silver_organise,
    silver_pay_band, silver_aux_columns, silver_quantile_band, silver_multi_split,
    silver_tech_long, silver_dedupe, silver_survey, catalog_profile, sql_view_query,
    gold_filter, gold_group, gold_aggregates, gold_quantiles, gold_quantiles_double, gold_quantiles_bigint, gold_distinct, gold_distinct_sketches,
    gold_crosstab, gold_crosstab_wide, gold_grouping_sets, gold_rollup, gold_cube,
    gold_rate, gold_index, gold_cramers_v, gold_correlation, gold_lift, gold_top_k,
    gold_top_k_per_group, gold_join_semi, gold_join_anti, gold_join_inner, gold_join_left,
    silver_schema_contract, gold_indicator_union,
)


def _compared(query: Query) -> Query:
    return lambda spark, sf: comparable(query(spark, sf))


QUERIES: dict[str, Query] = {
    **{q.__name__: _compared(q) for q in _OPERATORS},
    **{name: _compared(_front(name)) for name in fronts.GOLD_COLUMNS},
}
