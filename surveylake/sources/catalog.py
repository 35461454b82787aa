"""Tables in Spark's catalog: registered, described, queried with SQL."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from surveylake.rules import COMMENTS
from surveylake.sources.lake import Lake, paths, tables

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_DICTIONARY = "table string, column string, type string, nullable boolean, partition boolean, comment string"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition(folder: str) -> str:
    """``edition=2000`` as a partition of SQL."""
    parts = [p.split("=", 1) for p in folder.split("/")]
    return ", ".join(f"`{k}`=" + ("NULL" if v == _NO_VALUE else _text(unquote(v))) for k, v in parts)


def _columns(spark: SparkSession, full: str) -> list[tuple]:
    return [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(full)]


def register(
    spark: SparkSession, lake: Lake, layer: str, name: str,
    comment: str | None = None, comments: Mapping[str, str] = COMMENTS, replace: bool = False,
) -> str:
    """Make a table of the lake known by name, as of the newest snapshot; safe to run again.

    The table and its partitions point at the folders of that snapshot, so dropping or
    replacing it keeps the data. ``replace`` makes it anew where its columns have changed;
    else only the folders change, each in one step.
    """
    full = f"`{lake.database(layer)}`.`{name}`"
    found = tables(spark, lake, layer)[name]
    folders = paths(lake, layer, found)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{lake.database(layer)}`")
    columns = [(f.name, f.dataType.simpleString(), f.name in found.partition) for f in found.schema]
    if replace and spark.catalog.tableExists(full) and _columns(spark, full) != columns:
        spark.sql(f"DROP TABLE {full}")
    where = lake.path(layer, name) if found.partition else folders[""]
    listed = ", ".join(f"`{c}` {kind}" for c, kind, _ in columns)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in found.partition)})" if found.partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({listed}) USING parquet {parts} LOCATION {_text(where)}")
    if found.partition:
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
        for folder in sorted(known - set(folders)):
            spark.sql(f"ALTER TABLE {full} DROP PARTITION ({_partition(folder)})")
        for folder, path in folders.items():
            part = f"PARTITION ({_partition(folder)})"
            change = f"{part} SET LOCATION" if folder in known else f"ADD {part} LOCATION"
            spark.sql(f"ALTER TABLE {full} {change} {_text(path)}")
    else:
        spark.sql(f"ALTER TABLE {full} SET LOCATION {_text(where)}")
    spark.sql(f"REFRESH TABLE {full}")
    if comment:
        spark.sql(f"COMMENT ON TABLE {full} IS {_text(comment)}")
    for c in spark.catalog.listColumns(full):
        if c.name in comments and c.description != comments[c.name] and not c.isPartition:
            spark.sql(
                f"ALTER TABLE {full} ALTER COLUMN `{c.name}` COMMENT {_text(comments[c.name])}"
            )
    return full


def dictionary(spark: SparkSession, lake: Lake, layer: str) -> DataFrame:
    """One row per column of every registered table of the layer."""
    database = lake.database(layer)
    rows = []
    if spark.catalog.databaseExists(database):
        for t in spark.catalog.listTables(database):
            if not t.isTemporary:
                for c in spark.catalog.listColumns(f"`{database}`.`{t.name}`"):
                    rows.append((t.name, c.name, c.dataType, c.nullable, c.isPartition, c.description))
    return spark.createDataFrame(rows, _DICTIONARY)


def analyse(spark: SparkSession, lake: Lake, layer: str, name: str) -> None:
    """Store row counts and sizes, from which Spark decides how to join the table."""
    spark.sql(f"ANALYZE TABLE `{lake.database(layer)}`.`{name}` COMPUTE STATISTICS")


def sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SQL over registered tables, and over DataFrames: the text names each in braces, as ``FROM {answers}``."""
    return spark.sql(text, **(views or {}))
