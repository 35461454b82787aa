"""CSV records of large files, with line breaks inside quotes, read by many tasks.

A line break ends a record only outside quotes, which a task that starts in the middle
of a file cannot see. So every line is read as a function of the state before it: it may keep
the state, flip it, or end in a known one whatever was before.

1. Every split of a file composes the functions of its lines.
2. A prefix scan over the splits of a file, a row each, gives the state at their beginning.
3. With it every line knows whether a record starts there. Lines of one record
   are joined inside the split; only records that cross a border meet once more.

The lines are sorted within their split, never within their file, so no task gets more than a split.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_SPLIT = ["file", "block"]


def raw_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, at, value, size, time): every line with its file, the split it was read in and its order there."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("time"),
    ).withColumn("at", F.monotonically_increasing_id())


def _ends_inside(value: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it begins outside, and if it begins inside.

    A quote opens a field only at its beginning, and two quotes inside stand for one, as for Spark's own reader.
    """
    s = re.escape(sep)
    open_ = r'[^"]*+(?:""[^"]*+)*+'
    fields = rf'(?:(?:"{open_}"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+"{open_}$'
    quoted = F.instr(value, '"') > 0
    outside = quoted & value.rlike(f"^{fields}")
    inside = ~quoted | value.rlike(f"^{open_}$") | value.rlike(rf'^{open_}"[^{s}]*+{s}{fields}')
    return outside, inside


def _scan(df: DataFrame, outside: str, inside: str, window, prefix: str) -> DataFrame:
    """Adds ``{prefix}_flips`` and ``{prefix}_known``: the composed function of all rows up to each."""
    fixed = F.col(outside) == F.col(inside)
    flips = f"{prefix}_flips"
    df = df.withColumn(flips, F.sum((F.col(outside) & ~F.col(inside)).cast("int")).over(window))
    known = F.when(fixed, F.struct(F.col(outside).cast("int").alias("out"), F.col(flips).alias("flips")))
    return df.withColumn(f"{prefix}_known", F.last(known, ignorenulls=True).over(window))


def _after(before: Column, prefix: str) -> Column:
    """The state (1 inside quotes) that the composed function gives."""
    flips, known = F.col(f"{prefix}_flips"), F.col(f"{prefix}_known")
    return F.when(known.isNull(), before + flips).otherwise(known["out"] + flips - known["flips"]) % 2


def split_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """(file, size, time, position, record): the records of ``raw_lines``, empty ones left out.

    ``position`` grows along the file. A carriage return at the end of a line is part of the line break.
    """
    in_split = Window.partitionBy(*_SPLIT).orderBy("at")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outside, inside = _ends_inside(F.col("value"), sep)
    lines = lines.withColumn("value", F.regexp_replace("value", "\r$", ""))
    lines = lines.withColumns({"o": outside, "i": inside, "line": F.row_number().over(in_split) - 1})
    lines = _scan(lines, "o", "i", so_far, "line")

    zero, one = F.lit(0), F.lit(1)
    whole = F.max_by(F.struct(_after(zero, "line").alias("o"), _after(one, "line").alias("i")), "at")
    splits = lines.groupBy(*_SPLIT).agg(whole.alias("end"), F.max("line").alias("lines"))
    splits = splits.select(*_SPLIT, (F.col("end.o") == 1).alias("o"), (F.col("end.i") == 1).alias("i"))
    along = Window.partitionBy("file").orderBy("block")  # a row per split
    splits = _scan(splits, "o", "i", along.rowsBetween(Window.unboundedPreceding, Window.currentRow), "split")
    splits = splits.select(*_SPLIT, F.lag(_after(zero, "split"), 1, 0).over(along).alias("state"))

    lines = lines.join(splits, _SPLIT).withColumn("end", _after(F.col("state"), "line"))
    lines = lines.withColumn("begin", F.coalesce(F.lag("end").over(in_split), "state"))
    lines = lines.withColumn("number", F.sum((F.col("begin") == 0).cast("int")).over(so_far))
    place = (F.col("block") + F.col("line")).alias("position")
    about = [*_SPLIT, "size", "time"]

    single = lines.where("begin = 0 AND end = 0").select(*about, "number", place, F.col("value").alias("record"))
    parts = lines.where("begin <> 0 OR end <> 0").groupBy(*about, "number").agg(
        F.array_sort(F.collect_list(F.struct("line", "value"))).alias("all"), F.max_by("end", "line").alias("end"))
    parts = parts.select(
        *about, "number", "end", (F.col("block") + F.col("all")[0]["line"]).alias("position"),
        F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("record"))
    inner = parts.where("number > 0 AND end = 0").drop("end")
    # a record that a split leaves open goes on in the next ones up to the first that closes it
    broken = parts.where("number = 0 OR end <> 0")
    owner = F.last(F.when(F.col("number") > 0, F.col("position")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = broken.withColumn("owner", owner).groupBy("file", "size", "time", "owner").agg(
        F.min(F.struct("position", "block", "number")).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "record"))), lambda x: x["record"]), "\n").alias("record"))
    joined = joined.select("file", "at.block", "size", "time", "at.number", "at.position", "record")
    records = single.unionByName(inner).unionByName(joined)
    return records.where(F.length("record") > 0).select("file", "size", "time", "position", "record")


def header_names(header: str, sep: str = ",") -> tuple[str, ...]:
    """Column names of a header record: one without a name gets its number, a repeated one its number behind it."""
    row = next(csv.reader(header.removeprefix("\ufeff").splitlines(keepends=True), delimiter=sep), [])
    seen = [name.lower() for name in row]
    return tuple(
        f"_c{i}" if not name else f"{name}{i}" if seen.count(name.lower()) > 1 else name for i, name in enumerate(row))


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, header): the first line of every file, by one job over all of them."""
    lines = raw_lines(spark, path).where("block = 0").withColumn("value", F.regexp_replace("value", "\r$", ""))
    return lines.where(F.length("value") > 0).groupBy("file").agg(F.min_by("value", "at").alias("header"))


def _parsed(records: DataFrame, headers: Sequence[str], sep: str, corrupt: str | None) -> DataFrame:
    """A struct ``p0``, ``p1``, ... per header, filled where ``header`` is that one."""
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = {}
    for i, header in enumerate(headers):
        names = [*header_names(header, sep), *([corrupt] if corrupt else [])]
        schema = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)
        parsed[f"p{i}"] = F.from_csv(F.when(F.col("header") == header, F.col("record")), schema, options)
    return records.withColumns(parsed)


def read_records(spark: SparkSession, path: str | Sequence[str], sep: str = ",", corrupt: str | None = None) -> tuple[DataFrame, list[tuple]]:
    """CSV files whose fields may hold line breaks: (rows, headers).

    The rows have ``row_id``, ``file``, ``time``, a text column per name of any header (NULL in
    files without it), and ``corrupt``. ``row_id`` grows along the files in order of their paths.
    """
    records = split_records(raw_lines(spark, path), sep)
    heads = records.groupBy("file", "size").agg(F.min(F.struct("position", "record")).alias("head"))
    before = F.sum("size").over(Window.orderBy("file")) - F.col("size")  # a row per file
    heads = heads.select("file", F.col("head.position").alias("top"), F.col("head.record").alias("header"), before.alias("before"))
    headers = sorted(r["header"] for r in heads.select("header").distinct().collect())  # as many as the questionnaire had forms
    rows = _parsed(records.join(heads, "file").where(F.col("position") > F.col("top")), headers, sep, corrupt)
    holders: dict[str, list[str]] = {}
    for i, header in enumerate(headers):
        for name in header_names(header, sep):
            holders.setdefault(name, []).append(f"p{i}")
    names = {**holders, **({corrupt: [f"p{i}" for i in range(len(headers))]} if corrupt and headers else {})}
    columns = [F.coalesce(*[F.col(p)[name] for p in where]).alias(name) for name, where in names.items()]
    return rows.select((F.col("before") + F.col("position")).alias("row_id"), "file", "time", *columns), [header_names(h, sep) for h in headers]
