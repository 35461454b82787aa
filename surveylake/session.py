"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning carries the scale decisions: it joins by broadcast only
# when the measured side is under the threshold, splits skewed join partitions
# and merges small shuffle partitions. The number of shuffle partitions is left
# to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # the JVM does not compile methods above this size; beyond it, Spark then uses
    # generated code in smaller pieces (wide cleaning projections)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # call sites of every expression are not recorded: plans are built much faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "surveylake", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
