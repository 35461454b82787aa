"""Gold tables: edge fixtures and properties that hold for any answers."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from surveylake.checks.survey import survey_silver, survey_tech
from surveylake.operators import combine, groups, indicators
from surveylake.operators.combine import not_using, union_indicators, using
from surveylake.operators.crosstab import crosstab, crosstab_wide
from surveylake.operators.ranking import top_k
from surveylake.plans import fronts
from surveylake.plans.fronts import GOLD_TABLES, indicators as headline, tech_pairs
from surveylake.rules import SILVER_SCHEMA


def answers(spark, *rows):
    names = [f.name for f in SILVER_SCHEMA]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SILVER_SCHEMA)


@pytest.fixture(scope="module")
def silver(spark, small):
    df = survey_silver(spark, small).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", [*GOLD_TABLES, "indicators"])
def test_no_answers(spark, name):
    build = GOLD_TABLES.get(name, headline)
    got = build(answers(spark)).collect()
    # a grand total may remain, with nothing in it
    assert all(r["n"] == 0 for r in got)
    assert len(got) <= 1


@pytest.mark.parametrize("name", [*GOLD_TABLES, "indicators"])
def test_one_region_no_pay_one_technology(spark, name):
    rows = [
        dict(resp_id=i, edition=2000 + i % 2, role="Dev", region="Sul", state="PR", seniority="Pleno",
             seniority_rank=2, pay_band="sem dado", work_model="Remoto", ai_use=bool(i % 2),
             langs=["SQL"], n_tools=1, issues=[])
        for i in range(10)
    ]
    got = GOLD_TABLES.get(name, headline)(answers(spark, *rows)).collect()
    for r in got:
        d = r.asDict()
        for c in ("median", "p50", "mean", "median_with"):
            assert d.get(c) is None
    if name == "f4_adoption":
        assert [(r["technology"], r["n"], r["base"], r["pct"]) for r in got] == [("SQL", 10, 10, 100.0)]
    if name == "f4_tech_pairs":
        assert got == []
    if name == "f3_diversity":
        assert [(r["entropy"], r["evenness"], r["simpson"]) for r in got] == [(0.0, None, 0.0)]


def test_shares_add_up(silver):
    table = crosstab(silver, "seniority", "work_model")
    for by, pct in (("seniority", "row_pct"), ("work_model", "col_pct")):
        for r in table.groupBy(by).agg(F.sum(pct).alias("s")).collect():
            assert r["s"] == pytest.approx(100, abs=0.001)
    total = table.agg(F.sum("n").alias("n"), F.sum("total_pct").alias("s")).first()
    assert total["n"] == silver.count() and total["s"] == pytest.approx(100, abs=0.001)


def test_subtotals_add_up(silver):
    table = groups.rollup(silver, ["region", "state"])
    sums = {r["level"]: r["s"] for r in table.groupBy("level").agg(F.sum("n").alias("s")).collect()}
    assert sums == {0: silver.count(), 1: silver.count(), 3: silver.count()}
    levels = groups.cube(silver, ["role", "region"]).select("level").distinct().count()
    assert levels == 4


def test_rates_lie_between_0_and_1(silver):
    table = indicators.rate(silver, ["role", "region"], "ai_use")
    assert table.filter(~F.col("rate").between(0, 1)).count() == 0
    assert table.filter(F.col("hits") > F.col("base")).count() == 0


def test_small_groups_are_hidden(spark):
    df = answers(spark, dict(resp_id=1, role="a", ai_use=True), dict(resp_id=2, role="b", ai_use=True),
                 dict(resp_id=3, role="b", ai_use=None), dict(resp_id=4, role="b", ai_use=False))
    assert [tuple(r) for r in indicators.rate(df, ["role"], "ai_use", min_n=2).collect()] == [("b", 2, 1, 0.5)]
    assert groups.summarise(df, ["role"], min_n=2).count() == 1


def test_wide_crosstab_equals_long(silver):
    values = ["Presencial", "Remoto"]
    wide = crosstab_wide(silver, "role", "work_model", values)
    long = {(r["role"], r["work_model"]): r["n"] for r in crosstab(silver, "role", "work_model").collect()}
    for r in wide.collect():
        for v in values:
            assert r[v] == long.get((r["role"], v), 0)


def test_perfect_and_absent_association(spark):
    same = [dict(resp_id=i, role=str(i % 3), region=str(i % 3)) for i in range(30)]
    crossed = [dict(resp_id=i, role=str(i % 2), region=str(i // 2 % 2)) for i in range(40)]
    assert indicators.association(answers(spark, *same), "role", "region").first()["v"] == 1.0
    assert indicators.association(answers(spark, *crossed), "role", "region").first()["v"] == 0.0


def test_correlation_of_a_line(spark):
    df = spark.range(10).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    assert tuple(indicators.correlation(df, "x", "y").first()) == (10, 1.0, pytest.approx(18.33))


def test_top_k_ties_by_name(spark):
    df = spark.createDataFrame([("x", t) for t in "bbaacd"], "g string, t string")
    assert [tuple(r) for r in top_k(df, [], "t", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]
    got = top_k(df, ["g"], "t", 3).orderBy("place").collect()
    assert [(r["t"], r["place"]) for r in got] == [("a", 1), ("b", 2), ("c", 3)]


def test_using_and_not_using_split_the_answers(spark, small, silver):
    tech = survey_tech(spark, small)
    a, b = using(silver, tech, "lang", "PROMO"), not_using(silver, tech, "lang", "PROMO")
    assert a.count() + b.count() == silver.count()
    assert b.filter(F.array_contains("langs", "PROMO")).count() == 0


def test_pairs_against_brute_force(spark):
    lists = [["A", "B", "C"], ["A", "B"], ["C"], None, ["A", "C"]]
    df = answers(spark, *[dict(resp_id=i, langs=v, clouds=["Z"] if i < 2 else None) for i, v in enumerate(lists)])
    items = [[f"lang:{x}" for x in v or []] + (["cloud:Z"] if i < 2 else []) for i, v in enumerate(lists)]
    items = [set(x) for x in items if x]
    want = {}
    for a in sorted(set().union(*items)):
        for b in sorted(set().union(*items)):
            n = sum({a, b} <= x for x in items)
            if a < b and n:
                na, nb = sum(a in x for x in items), sum(b in x for x in items)
                want[a, b] = (n, round(n / len(items), 4), round(n * len(items) / na / nb, 4))
    got = {(r["a"], r["b"]): (r["n"], r["support"], r["lift"]) for r in tech_pairs(df).collect()}
    assert got == want


def test_opportunity_ranks_high_pay_and_little_ai_first(spark):
    rows = []
    for i in range(20):
        rich = i % 2 == 0
        rows.append(dict(resp_id=i, role="a" if rich else "b", region="r", seniority="Pleno", seniority_rank=2,
                         pay=Decimal(300 if rich else 100), ai_use=not rich))
    got = GOLD_TABLES["f5_opportunity"](answers(spark, *rows)).orderBy("place").collect()
    assert [(r["role"], r["pay_index"], r["ai_rate"], r["score"], r["place"]) for r in got] == [
        ("a", 150.0, 0.0, 1.5, 1), ("b", 50.0, 1.0, 0.0, 2)]


def test_profile_estimates(silver):
    exact = {r["column"]: r for r in groups.profile(silver, ["role", "pay"], exact=True).collect()}
    near = {r["column"]: r for r in groups.profile(silver, ["role", "pay"]).collect()}
    for c in exact:
        assert exact[c]["nulls"] == near[c]["nulls"]
        assert near[c]["distinct_values"] == pytest.approx(exact[c]["distinct_values"], rel=0.1)


def test_exact_profile_of_wide_and_empty_tables(spark):
    """70 columns, more than grouping sets take, with names that are used inside; NULLs, NaN and no rows."""
    rows = [(1, 2.5, "b"), (1, float("nan"), None), (None, None, "a"), (3, 2.5, "b")]
    few = spark.createDataFrame(rows, "n int, level double, _weight string")
    wide = few.select("*", *[F.lit(i).alias(f"x{i}") for i in range(67)])
    got = [tuple(r) for r in groups.profile(wide, exact=True).collect()]
    assert got[:3] == [("n", 4, 1, 2, "1", "3"), ("level", 4, 1, 2, "2.5", "NaN"), ("_weight", 4, 1, 2, "a", "b")]
    assert got[3:] == [(f"x{i}", 4, 0, 1, str(i), str(i)) for i in range(67)]
    assert [tuple(r) for r in groups.profile(few.limit(0), exact=True).collect()] == [(c, 0, 0, 0, None, None) for c in few.columns]


def test_stacking_tables_with_different_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, union_indicators(a, b).collect()), key=str) == [(1, 2), (3, None)]


def test_change_is_against_the_edition_before_in_the_survey(spark):
    df = spark.createDataFrame(
        [("a", 2019), ("a", 2021), ("a", 2021), ("b", 2020)], "role string, edition int")
    got = sorted(tuple(r)[:5] for r in fronts.edition_change(df).collect())
    assert got == [
        ("a", 2019, 1, None, None), ("a", 2020, 0, 1, -1), ("a", 2021, 2, 0, 2),
        ("b", 2019, 0, None, None), ("b", 2020, 1, 0, 1), ("b", 2021, 0, 1, -1)]


def test_distinct_values_may_be_estimated(spark):
    df = spark.range(2_000).selectExpr("id % 2 AS g", "id AS v")
    for r in groups.summarise(df, ["g"], distinct="v", exact=False).collect():
        assert abs(r["v_distinct"] - 1_000) < 150


def test_technologies_join_either_way(spark):
    answers = spark.createDataFrame([(1, "a"), (2, "b")], "resp_id long, role string")
    tech = spark.createDataFrame([(1, "lang", "SQL"), (1, "lang", "R")], "resp_id long, category string, technology string")
    assert combine.with_technologies(answers, tech).count() == 2
    assert combine.with_technologies(answers, tech, "left").count() == 3
    with pytest.raises(ValueError):
        combine.with_technologies(answers, tech, "cross")


def test_pay_by_technology_reads_pay_once(spark, oracle_dir):
    """No filter on pay is moved to the raw answers, and technologies that only unpaid answers name stay out."""
    table = fronts.pay_tech(survey_silver(spark, oracle_dir, fronts.GOLD_COLUMNS["f4_pay_tech"]))
    assert not [x for x in table._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "RLIKE" in x]
    silver = spark.createDataFrame(
        [(Decimal("10.00"), ["A", "B"], ["X"]), (Decimal("30.00"), ["A"], None), (None, ["A", "C"], ["Y"])],
        "pay decimal(12,2), langs array<string>, bi_tools array<string>",
    ).withColumns({c: F.lit(None).cast("array<string>") for c in ("databases", "clouds")})
    found = {(r["technology"], r["n"], r["mean"], r["median"], r["index"]) for r in fronts.pay_tech(silver).collect()}
    assert found == {("A", 2, 20.0, 20.0, 100.0), ("B", 1, 10.0, 10.0, 50.0), ("X", 1, 10.0, 10.0, 100.0)}
    answers = silver.withColumns({"seniority": F.lit("s"), "ai_use": F.col("bi_tools").isNotNull()})
    by_ai = fronts.ai_pay(answers.filter(F.col("pay").isNull())).collect()
    assert by_ai == []
