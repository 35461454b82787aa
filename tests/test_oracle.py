"""Every registered query against its SQL. ORACLE_SF picks the scale (0.001)."""

import pytest

import __spark_entry__ as driver
from surveylake.checks.oracle import ORACLE
from surveylake.checks.queries import QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def duck(oracle_dir):
    con = connect(oracle_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(ran, duck, name):
    columns, dtypes, rows, _ = ran(name)
    assert differences(columns, dtypes, rows, duck, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert df.columns == ["seniority", "n", "mean", "p25", "p50", "p75"]
    assert df.count() == 5


def test_known_answers(spark, testdata):
    """Counts given with the fixture's description, at sf0.01."""
    from pyspark.sql import functions as F
    from surveylake.checks.survey import survey_silver

    silver = survey_silver(spark, f"{testdata}/sf0.01", ["resp_id", "pay", "work_model", "ai_use"])
    row = silver.agg(F.count("*"), F.count("pay"), F.count("work_model"), F.count("ai_use")).first()
    assert tuple(row) == (15_000, 13_936, 14_594, 14_743)
