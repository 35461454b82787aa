"""Distinct values from stored sketches, against counts of the values themselves."""

import pytest
from pyspark.sql import functions as F

from surveylake.operators.sketches import compared, distinct_sketches, distinct_values, united


def sets(rows, key, column):
    out = {}
    for r in rows:
        out.setdefault(r[key], set()).update({r[column]} - {None})
    return out


@pytest.fixture
def parts(spark):
    """Three overlapping editions of 6,000 values, one without any, and one edition NULL."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 29_000, (F.col("id") % 4).cast("int")).alias("edition"),
        F.when(F.col("id") % 4 != 3, F.col("id") % 6_007).alias("code"), (F.col("id") % 5).cast("string").alias("label"))
    return rows


def test_small_sets_are_exact(parts):
    sketches = distinct_sketches(parts, ["edition"], ["code", "label"]).persist()
    rows = parts.collect()
    codes, labels = sets(rows, "edition", "code"), sets(rows, "edition", "label")
    got = {(r["edition"], r["column"]): r["distinct_values"] for r in distinct_values(sketches, ["edition"]).collect()}
    assert got == {**{(e, "code"): len(v) for e, v in codes.items()}, **{(e, "label"): len(v) for e, v in labels.items()}}
    whole = {r["column"]: r["distinct_values"] for r in distinct_values(sketches).collect()}
    assert whole == {"code": len(set().union(*codes.values())), "label": 5}
    e = F.col("edition")
    row = compared(sketches, e.isin(0, 1), e == 2).where(F.col("column") == "code").first()
    a, b = codes[0] | codes[1], codes[2]
    assert tuple(row)[1:] == (len(a), len(b), len(a & b), len(a | b), len(a - b), len(b - a))
    nobody = compared(sketches, e == 99, e == 0).where(F.col("column") == "code").first()
    assert tuple(nobody)[1:] == (0, len(codes[0]), 0, len(codes[0]), 0, len(codes[0]))


def test_parts_may_be_cut_and_united_in_any_way(parts):
    one = united(distinct_sketches(parts.repartition(1), [], ["code"]))
    many = united(united(distinct_sketches(parts.repartition(7), ["edition", "label"], ["code"]), ["label"]))
    assert [tuple(r) for r in distinct_values(one).collect()] == [tuple(r) for r in distinct_values(many).collect()]


def test_large_sets_are_within_the_bound(spark):
    df = spark.range(400_000).select((F.col("id") % 2).alias("edition"), F.when(F.col("id") < 200_000, F.col("id")).otherwise(F.col("id") - F.col("id") % 2).alias("code"))
    sketches = distinct_sketches(df, ["edition"], ["code"]).persist()
    bound = 3 / 2 ** 7  # three standard errors at 2 ** 14 entries
    exact = df.agg(F.count_distinct("code")).first()[0]
    assert abs(distinct_values(sketches).first()["distinct_values"] / exact - 1) < bound
    row = compared(sketches, F.col("edition") == 0, F.col("edition") == 1).first()
    assert abs(row["both"] - 100_000) < bound * exact and abs(row["either"] - exact) < bound * exact


def test_no_rows(spark):
    empty = spark.createDataFrame([], "edition int, code string")
    assert distinct_sketches(empty, ["edition"], ["code"]).collect() == []
    assert [tuple(r) for r in distinct_values(distinct_sketches(empty, [], ["code"])).collect()] == [("code", 0)]
