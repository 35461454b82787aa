"""Exact quantiles against a plain computation."""

import math
import random
import re
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from surveylake.operators.quantiles import quantiles

PS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
SCHEMA = "g string, v decimal(12,2)"


def brute(rows):
    groups = defaultdict(list)
    for g, v in rows:
        groups[g] += [] if v is None else [float(v)]
    out = {}
    for g, vs in groups.items():
        qs = np.quantile(vs, list(PS.values())) if vs else [None] * len(PS)
        out[g] = (len(vs), np.mean(vs) if vs else None, *qs)
    return out


def check(df, rows):
    got = {r["g"]: tuple(r)[1:] for r in df.collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for g in want:
        assert got[g][0] == want[g][0]
        if want[g][0] == 0:
            assert got[g][1:] == (None,) * (len(PS) + 1)
        else:
            assert np.allclose(got[g][1:], want[g][1:], rtol=1e-12, atol=1e-6)


def test_skewed_group_wide_range_and_nulls(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(6_000):
        g = "hot" if i % 3 else [None, "a", "b", "empty"][i % 4]
        cents = int(rng.integers(-(10**12) + 1, 10**12)) if i % 2 else int(rng.integers(0, 50))
        v = None if g == "empty" or i % 17 == 0 else Decimal(cents) / 100
        rows.append((g, v))
    df = quantiles(spark.createDataFrame(rows, SCHEMA), ["g"], "v", PS)
    check(df, rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.decimals(-9_999_999_999, 9_999_999_999, places=2)),
), min_size=1, max_size=40))
def test_any_rows(spark, rows):
    check(quantiles(spark.createDataFrame(rows, SCHEMA), ["g"], "v", PS), rows)


def test_values_that_share_a_bucket_and_cross_its_edge(spark):
    edge = 1 << 20
    rows = [("a", Decimal(edge + d) / 100) for d in range(-5, 6)] * 3
    check(quantiles(spark.createDataFrame(rows, SCHEMA), ["g"], "v", PS), rows)


def test_ordered_and_independent_of_partitions(spark, small):
    from surveylake.checks.survey import survey_silver

    silver = survey_silver(spark, small, ["seniority", "pay"])
    one = quantiles(silver.coalesce(1), ["seniority"], "pay", PS).collect()
    many = quantiles(silver.repartition(8), ["seniority"], "pay", PS).collect()
    assert sorted(one, key=str) == sorted(many, key=str)
    for r in one:
        assert list(r)[3:] == sorted(list(r)[3:])


def test_grouping_sets_equal_separate_groupings(spark):
    rows = [("x", "1", Decimal(i)) for i in range(9)] + [("y", "1", Decimal(5)), (None, "2", Decimal(7))]
    df = spark.createDataFrame(rows, "a string, b string, v decimal(12,2)")
    sets = quantiles(df, ["a", "b"], "v", {"m": 0.5}, sets=[["a"], []])
    by_a = quantiles(df, ["a"], "v", {"m": 0.5})
    assert sorted(map(tuple, sets.filter("level = 1").select("a", "n", "m").collect()), key=str) == \
        sorted(map(tuple, by_a.select("a", "n", "m").collect()), key=str)
    assert [tuple(r) for r in sets.filter("level = 3").select("n", "m").collect()] == [(11, 5.0)]


def test_no_group_and_no_rows(spark):
    df = spark.createDataFrame([("a", Decimal(1)), ("a", Decimal(2))], SCHEMA)
    assert [tuple(r) for r in quantiles(df, [], "v", {"m": 0.5}).collect()] == [(2, 1.5, 1.5)]
    assert quantiles(df.limit(0), ["g"], "v", {"m": 0.5}).count() == 0


def test_estimates_are_near(spark):
    df = spark.range(1, 10_001).select(
        F.lit("a").alias("g"), F.col("id").cast("decimal(12,2)").alias("v")
    )
    row = quantiles(df, ["g"], "v", {"m": 0.5}, exact=False).first()
    assert row["n"] == 10_000 and abs(row["m"] - 5_000) < 20


def exact_answers(values):
    """Neighbours of every position among sorted values, interpolated as doubles."""
    ordered, out = sorted(values, key=lambda v: (math.isnan(v), v)), []
    for p in PS.values():
        position = (len(ordered) - 1) * p
        low, high, part = float(ordered[math.floor(position)]), float(ordered[math.ceil(position)]), position % 1
        out.append(low if part == 0 or low == high else low + (high - low) * part)
    return out


EDGES = {
    "bigint": [-(1 << 63), (1 << 63) - 1, 0, -1, 1, *[s * (1 << b) + d for s in (-1, 1) for b in (20, 21, 42, 43, 44, 62) for d in (-1, 0, 1)]],
    "smallint": [-(1 << 15), (1 << 15) - 1, 0, 5, 5],
    "double": [math.inf, -math.inf, 0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.2250738585072014e-308, 1 + 2**-52, 1.0, math.nan, math.nan],
    "decimal(18,4)": [Decimal(f"{n}e-4") for n in (10**18 - 1, 1 - 10**18, 1, 0, -1)],
    "decimal(38,10)": [Decimal(f"{s * (10**e + d)}e-10") for s in (-1, 1) for e in (0, 5, 6, 7, 12, 30, 35, 37) for d in (-1, 0, 1)],
    "decimal(38,0)": [Decimal(10**38 - 1), Decimal(1 - 10**38), Decimal(0), *[Decimal(10**e + d) for e in (6, 18, 36) for d in (-1, 0, 1)]],
    "decimal(20,20)": [Decimal(f"{n}e-20") for n in (1, -1, 10**20 - 1)],
}


@pytest.mark.parametrize("kind", EDGES)
def test_every_number_type_at_its_edges(spark, kind):
    edges = EDGES[kind]
    groups = {"all": edges, "few": edges[:3], "one": edges[:1] * 3, "none": []}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("all", None)]
    found = {r["g"]: r for r in quantiles(spark.createDataFrame(rows, f"g string, v {kind}"), ["g"], "v", PS).collect()}
    for g, vs in groups.items():
        assert found[g]["n"] == len(vs)
        got = [found[g][p] for p in PS]
        if not vs:
            assert got == [None] * len(PS) and found[g]["mean"] is None
            continue
        assert all(a == b or math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-15) for a, b in zip(got, exact_answers(vs))), (g, got)
        assert str(got[0]) != "-0.0"


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(30,6)"])
def test_wide_types_with_a_hot_group(spark, kind):
    rng = random.Random(7)
    draw = {"bigint": lambda: rng.randrange(-(1 << 62), 1 << 62), "double": lambda: rng.gauss(0, 1) * 10 ** rng.randrange(-9, 9),
            "decimal(30,6)": lambda: Decimal(f"{rng.randrange(-(10**29), 10**29)}e-6")}[kind]
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), draw() if i % 7 else None) for i in range(4_000)]
    found = quantiles(spark.createDataFrame(rows, f"g string, v {kind}"), ["g"], "v", PS).collect()
    for r in found:
        values = [v for g, v in rows if g == r["g"] and v is not None]
        assert r["n"] == len(values) and math.isclose(r["mean"], float(sum(values)) / len(values), rel_tol=1e-9, abs_tol=1e-6)
        assert np.allclose([r[p] for p in PS], exact_answers(values), rtol=1e-14)


def test_grouping_sets_of_doubles(spark):
    rows = [("x", "1", 0.5), ("x", "2", -1.5), ("y", "1", 1e300)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    got = {(r["level"], r["a"]): r["m"] for r in quantiles(df, ["a", "b"], "v", {"m": 0.5}, sets=[["a"], []]).collect()}
    assert got == {(1, "x"): -0.5, (1, "y"): 1e300, (3, None): 0.5}


def test_no_task_sorts_a_hot_group_of_doubles(spark):
    """Values of one group meet only in windows of one bucket: the widest sorted window is far below the group."""
    from plan_text import final_plan

    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.rand(3).alias("v"))
    found = quantiles(df, ["g"], "v", {"m": 0.5})
    found.collect()
    plan = final_plan(found)
    # all sorts of counted values are by group and bucket; none is by the group and the value alone
    assert "Window" in plan and not re.search(r"Sort \[g#\d+ ASC NULLS FIRST, v#\d+ ASC", plan)
    assert "Python" not in plan


def test_other_types_and_bad_shares_are_refused(spark):
    with pytest.raises(ValueError, match="need numbers"):
        quantiles(spark.createDataFrame([], SCHEMA), [], "g", {"m": 0.5})
    with pytest.raises(ValueError, match="must be in"):
        quantiles(spark.createDataFrame([], SCHEMA), ["g"], "v", {"m": 1.5})
