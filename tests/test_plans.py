"""What the plans must look like to hold at scale."""

import pytest

from plan_text import scans
from surveylake.checks.queries import QUERIES
from surveylake.plans.fronts import GOLD_COLUMNS

# Queries that put two tables together, or values of a group and its rows, by definition.
SEVERAL_READS = {"silver_trace": 2, "gold_join_semi": 2, "gold_join_anti": 2, "gold_join_inner": 2, "gold_join_left": 2,
                 "silver_impute_median": 2, "silver_quantile_band": 2}
NO_SHUFFLE = (
    "silver_missing_sentinels", "silver_fill_constant", "silver_drop_missing", "silver_types_money",
    "silver_types_date", "silver_invalid_range", "silver_clamp", "silver_invalid_domain",
    "silver_text_key", "silver_category_map", "silver_pay_band", "gold_filter",
)


@pytest.fixture(scope="module")
def plans(ran):
    return lambda name: ran(name)[3]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_answers_are_read_once_and_stay_in_the_jvm(plans, name):
    plan = plans(name)
    assert scans(plan, "orders") == SEVERAL_READS.get(name, 1)
    for word in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval"):
        assert word not in plan


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_cleaning_does_not_shuffle(plans, name):
    plan = plans(name)
    # building the tool lists of the stand-in survey shuffles; nothing else may
    allowed = 2 if scans(plan, "lineitem") else 0
    assert plan.count("Exchange hashpartitioning") <= allowed


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("gold_", "f"))))
def test_windows_run_over_aggregated_rows(plans, name):
    lines = plans(name).splitlines()
    for i, text in enumerate(lines):
        if "+- Window [" in text or "- *" in text and ") Window [" in text:
            assert any("Aggregate(" in below for below in lines[i + 1:])


def test_segments_are_not_ranked_in_one_task(plans):
    lines = plans("f5_opportunity").splitlines()
    windows = [i for i, text in enumerate(lines) if "Window [" in text]
    assert windows and not any("SinglePartition" in below for i in windows for below in lines[i + 1:i + 7])


@pytest.mark.parametrize("name", sorted(GOLD_COLUMNS))
def test_only_the_needed_tables_are_read(plans, name):
    plan, columns = plans(name), set(GOLD_COLUMNS[name])
    assert bool(scans(plan, "customer")) == bool(columns & {"role", "region", "state"})
    tools = columns & {"langs", "bi_tools", "databases", "clouds", "ai_use", "n_tools"}
    assert bool(scans(plan, "lineitem")) == bool(tools)


@pytest.mark.parametrize("name", ["f2_pay_seniority", "gold_quantiles", "f4_pay_tech", "f2_pay_role_seniority"])
def test_quantiles_spread_a_group_and_reuse_the_counts(plans, name):
    plan = plans(name)
    assert "ReusedExchange" in plan
    assert "percentile" not in plan and "ObjectHashAggregate(keys=[g" not in plan


def test_top_k_is_cut_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans("gold_top_k_per_group")
    assert "TakeOrderedAndProject" in plans("gold_top_k")


def test_profile_counts_values_without_sorting_answers(plans):
    plan = plans("catalog_profile")
    assert "HashAggregate(keys=[c0" in plan and "SortAggregate(key=[c" not in plan and "SortAggregate(key=[pay" not in plan
    assert not [x for x in plan.splitlines() if "SortAggregate(key=[" in x and "SortAggregate(key=[]" not in x]


def test_profile_stays_in_methods_that_the_jvm_compiles(spark, small):
    """The JVM leaves methods of over 8,000 bytes uncompiled; Spark makes them up to 65,535 by default."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["catalog_profile"](spark, small)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    assert 0 < max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8_000
