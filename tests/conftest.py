import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from surveylake.session import get_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "surveylake-tests", "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.maxMetadataStringLength": "400",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    return TESTDATA


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def ran(spark, oracle_dir):
    """Registered queries, each run once: columns, types, rows and the plan that ran."""
    from plan_text import final_plan
    from surveylake.checks.queries import QUERIES

    done = {}

    def run(name):
        if name not in done:
            df = QUERIES[name](spark, oracle_dir)
            rows = [tuple(r) for r in df.collect()]
            done[name] = (df.columns, df.dtypes, rows, final_plan(df))
        return done[name]

    return run


@pytest.fixture(scope="session")
def oracle_dir():
    return f"{TESTDATA}/sf{os.environ.get('ORACLE_SF', '0.001')}"
