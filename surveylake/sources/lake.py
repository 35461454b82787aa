"""Lake tables: one folder per table in each of three layers, published by snapshots.

A table's files are written beside the ones in use, below ``_version=...``. They count
only once a snapshot of the layer names them. A snapshot is a small table of its own, written
last, with one row per table and partition; it is complete when Spark has put its success
marker there. So a job that dies leaves the tables as they were, several tables change
together, and a partition can be replaced without touching the others.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from surveylake.functions import join_list

LAYERS = ("bronze", "silver", "gold")
SNAPSHOTS, VERSION = "_snapshots", "_version"
_ROWS = "name string, columns string, partition array<string>, folder string, version string, source bigint"


@dataclass(frozen=True)
class Lake:
    """A root folder, on any file system Spark can reach, and its databases."""

    root: str
    prefix: str = "survey"

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def database(self, layer: str) -> str:
        self.path(layer, "")
        return f"{self.prefix}_{layer}"


@dataclass(frozen=True)
class Table:
    """A table of a snapshot: version by partition folder (``""`` if it has no partitions), columns by folder.

    ``source`` is the snapshot of the layer below that it was made from, if that is known.
    """

    name: str
    partition: tuple[str, ...]
    versions: Mapping[str, str]
    columns: Mapping[str, T.StructType]
    source: int | None = None

    @property
    def schema(self) -> T.StructType:
        """The columns of all partitions by name, in the order of their first appearance, partition columns last."""
        fields: dict[str, T.StructField] = {}
        for folder in sorted(self.columns):
            for f in self.columns[folder]:
                if fields.setdefault(f.name, f).dataType != f.dataType:
                    raise ValueError(f"{f.name} of {self.name} is {f.dataType} in {folder or 'it'} and {fields[f.name].dataType} elsewhere")
        last = [fields.pop(c) for c in self.partition if c in fields]
        return T.StructType([*fields.values(), *last])


def _nullable(kind: T.DataType) -> T.DataType:
    """The same type, with room for NULL everywhere, as files have it."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    return kind


# --- files --------------------------------------------------------------------


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names below a folder, and when they were changed."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(where))


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.exists(where)


# --- snapshots ----------------------------------------------------------------


def snapshots(spark: SparkSession, lake: Lake, layer: str) -> list[int]:
    """Numbers of the complete snapshots of a layer, oldest first."""
    root = lake.path(layer, SNAPSHOTS)
    numbers = [name for name, _ in _children(spark, root) if name.isdigit()]
    return [int(n) for n in numbers if _exists(spark, f"{root}/{n}/_SUCCESS")]


def tables(spark: SparkSession, lake: Lake, layer: str, snapshot: int | None = None) -> dict[str, Table]:
    """The tables of a snapshot, the newest by default; no snapshot has no tables."""
    known = snapshots(spark, lake, layer)
    if snapshot is None:
        snapshot = known[-1] if known else None
    elif snapshot not in known:
        raise ValueError(f"{layer} has no snapshot {snapshot}")
    if snapshot is None:
        return {}
    found: dict[str, Table] = {}
    # a row per partition: as many as the tables have
    for r in spark.read.schema(_ROWS).json(f"{lake.path(layer, SNAPSHOTS)}/{snapshot:010d}").collect():
        t = found.setdefault(r["name"], Table(r["name"], tuple(r["partition"]), {}, {}, r["source"]))
        t.columns[r["folder"] or ""] = T.StructType.fromJson(json.loads(r["columns"]))
        if r["version"]:
            t.versions[r["folder"] or ""] = r["version"]
    return found


def _commit(spark: SparkSession, lake: Lake, layer: str, found: Iterable[Table]) -> int:
    rows = [
        (t.name, columns.json(), list(t.partition), folder, t.versions.get(folder), t.source)
        for t in found for folder, columns in t.columns.items()
    ]
    root = lake.path(layer, SNAPSHOTS)
    # one that a job began and did not finish keeps its number; Spark refuses a number that is taken
    number = 1 + max((int(name) for name, _ in _children(spark, root) if name.isdigit()), default=0)
    spark.createDataFrame(rows, _ROWS).coalesce(1).write.json(f"{root}/{number:010d}")
    return number


def stage(
    df: DataFrame, lake: Lake, layer: str, name: str,
    partition: Sequence[str] = (), rebalance: bool = True, source: int | None = None,
) -> Table:
    """Write a table's files without making them visible.

    Rows are rebalanced first: Spark splits a hot partition and merges small
    ones by their measured size, so a small gold table is one file and a large
    silver edition is many, without passing through a single task. A table made
    row by row from another one keeps that one's file sizes: ``rebalance=False``
    then saves a shuffle of all its rows.
    """
    spark, version = df.sparkSession, f"v{uuid.uuid4().hex}"
    path = f"{lake.path(layer, name)}/{VERSION}={version}"
    writer = (df.hint("rebalance", *partition) if rebalance else df).write
    if partition:
        writer = writer.partitionBy(*partition)
    writer.parquet(path)
    folders = [""]
    for _ in partition:
        folders = [f"{f}/{c}".lstrip("/") for f in folders for c, _ in _children(spark, f"{path}/{f}") if "=" in c]
    columns = _nullable(df.schema)
    if partition and not folders:
        return Table(name, tuple(partition), {}, {"": columns}, source)
    return Table(name, tuple(partition), {f: version for f in folders}, {f: columns for f in folders}, source)


def publish(
    spark: SparkSession, lake: Lake, layer: str, staged: Sequence[Table],
    only: Mapping[str, Iterable[str]] | None = None,
) -> int:
    """Make staged tables visible, all at once; returns the number of the snapshot.

    ``only`` names the partition folders of a table that are replaced, or removed where
    nothing was staged for them; its other partitions stay. Other tables stay.
    """
    after = tables(spark, lake, layer)
    for t in staged:
        before = after.get(t.name)
        if only is not None and t.name in only and before is not None:
            kept = {f: v for f, v in before.versions.items() if f not in set(only[t.name])}
            columns = {f: before.columns[f] for f in kept}
            if not kept and not t.versions:
                columns = dict(t.columns)
            t = replace(t, versions={**kept, **t.versions}, columns={**columns, **{f: t.columns[f] for f in t.versions}})
        after[t.name] = t
    return _commit(spark, lake, layer, after.values())


def paths(lake: Lake, layer: str, table: Table) -> dict[str, str]:
    """The folder of every partition."""
    root = lake.path(layer, table.name)
    return {f: f"{root}/{VERSION}={v}" + (f"/{f}" if f else "") for f, v in table.versions.items()}


def read_parts(spark: SparkSession, lake: Lake, layer: str, table: Table, folders: Iterable[str] | None = None) -> DataFrame:
    """A table as a snapshot or a staged write has it, or some of its partitions; missing columns are NULL."""
    where = paths(lake, layer, table)
    wanted = list(where.values()) if folders is None else [where[f] for f in folders if f in where]
    if not wanted:
        return spark.createDataFrame([], table.schema)
    read = spark.read.schema(table.schema).option("basePath", lake.path(layer, table.name)).parquet(*wanted)
    return read.select(*[F.col(f"`{f.name}`") for f in table.schema])


def read_table(spark: SparkSession, lake: Lake, layer: str, name: str, snapshot: int | None = None) -> DataFrame:
    """A table of the lake, as of its newest or a given snapshot; batches of bronze may have different columns, and all are read."""
    found = tables(spark, lake, layer, snapshot)
    if name not in found:
        if snapshot is None and _exists(spark, lake.path(layer, name)):  # written without snapshots
            return spark.read.option("mergeSchema", layer == "bronze").parquet(lake.path(layer, name))
        raise ValueError(f"{layer} has no table {name}")
    return read_parts(spark, lake, layer, found[name])


def write_table(
    df: DataFrame, lake: Lake, layer: str, name: str,
    partition: Sequence[str] = (), rebalance: bool = True,
) -> str:
    """Replace a table at once; returns the folder of its files."""
    table = stage(df, lake, layer, name, partition, rebalance)
    publish(df.sparkSession, lake, layer, [table])
    return f"{lake.path(layer, name)}/{VERSION}={next(iter(table.versions.values()), '')}"


def stage_batch(df: DataFrame, lake: Lake, name: str, batch_id: int) -> Table:
    """Write one batch of a bronze table without making it visible; it may have no rows."""
    version, folder = f"v{uuid.uuid4().hex}", f"_batch_id={batch_id}"
    df.write.parquet(f"{lake.path('bronze', name)}/{VERSION}={version}/{folder}")
    columns = T.StructType([*_nullable(df.schema), T.StructField("_batch_id", T.IntegerType())])
    return Table(name, ("_batch_id",), {folder: version}, {folder: columns})


def write_batch(df: DataFrame, lake: Lake, name: str, batch_id: int) -> str:
    """Replace one batch of a bronze table at once and leave the other batches alone."""
    table = stage_batch(df, lake, name, batch_id)
    publish(df.sparkSession, lake, "bronze", [table], {name: list(table.versions)})
    return lake.path("bronze", name)


def changed(old: Table, new: Table) -> list[str]:
    """Partition folders that differ between two snapshots of a table."""
    return sorted(f for f in {*old.versions, *new.versions} if old.versions.get(f) != new.versions.get(f))


def vacuum(spark: SparkSession, lake: Lake, layer: str, keep: int = 2, older_than: float = 86_400) -> int:
    """Delete files and snapshots that none of the last ``keep`` snapshots needs; returns how many folders went.

    Files younger than ``older_than`` seconds stay: a job may have staged them.
    """
    if keep < 1:
        raise ValueError("the newest snapshot is in use")
    known = snapshots(spark, lake, layer)
    used: dict[str, set] = {}
    for number in known[-keep:]:
        for t in tables(spark, lake, layer, number).values():
            used.setdefault(t.name, set()).update(t.versions.values())
    limit, gone = (time.time() - older_than) * 1000, 0

    def drop(path: str) -> int:
        files, where = _folder(spark, path)
        return int(files.delete(where, True))

    for name, _ in _children(spark, lake.path(layer, "")):
        for version, changed_at in _children(spark, lake.path(layer, name)) if name != SNAPSHOTS else []:
            found = re.fullmatch(f"{VERSION}=(.+)", version)
            if found and found[1] not in used.get(name, ()) and changed_at <= limit:
                gone += drop(f"{lake.path(layer, name)}/{version}")
    for number in known[:-keep]:
        gone += drop(f"{lake.path(layer, SNAPSHOTS)}/{number:010d}")
    return gone


# --- CSV ----------------------------------------------------------------------


def export_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """Write CSV with a header, a file per task; lists become text joined by ``;``."""
    flat = df.select(*[
        join_list(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])
    (
        flat.write.mode("overwrite")
        .option("header", True).option("sep", sep).option("escape", '"')
        .csv(path)
    )
    return path


def read_csv_export(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Read an export back; list columns are split again."""
    lists = [f.name for f in schema if isinstance(f.dataType, T.ArrayType)]
    text = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in lists else f.dataType) for f in schema
    ])
    df = (
        spark.read.schema(text).option("header", True).option("escape", '"')
        .option("multiLine", multi_line).csv(path)
    )
    return df.withColumns({c: F.split(F.col(c), ";") for c in lists}) if lists else df
