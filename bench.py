"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_RUNS (default 3) and BENCH_QUERIES (comma-separated names; default: the
silver pipeline and every gold table). Each query is run once to warm up, then
timed BENCH_RUNS times with the ``noop`` writer; the median counts. These entries
build the survey from the given tables each time. ``stored`` times the gold tables
once each, after a warm-up, from a silver table written before, as the gold job does.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from surveylake.checks.queries import QUERIES
from surveylake.checks.survey import survey_silver
from surveylake.plans.fronts import GOLD_COLUMNS, GOLD_TABLES
from surveylake.session import get_session

HEADLINES = ("silver_survey", "silver_tech_long", "silver_dedupe", "silver_impute_median", *GOLD_COLUMNS)


def from_stored(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds of each gold table from stored silver answers."""
    seconds = {}
    with tempfile.TemporaryDirectory() as folder:
        survey_silver(spark, sf_dir).write.parquet(f"{folder}/answers")
        silver = spark.read.parquet(f"{folder}/answers")
        for name, build in GOLD_TABLES.items():
            for _ in range(2):
                start = time.perf_counter()
                build(silver).write.format("noop").mode("overwrite").save()
                seconds[name] = round(time.perf_counter() - start, 4)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINES
    spark = get_session(
        "surveylake-bench", f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    stored = {} if os.environ.get("BENCH_QUERIES") else from_stored(spark, sf_dir)
    spark.stop()
    print(json.dumps({
        "metric": "survey_total_seconds", "value": round(sum(seconds.values()), 4), "unit": "sec",
        "queries": seconds, "stored": stored, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
