"""Raw files to the bronze layer, and the way back from a derived row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from surveylake.sources.lake import Lake, write_batch
from surveylake.sources.records import first_lines, header_names, read_records

CORRUPT = "_corrupt_record"
ORIGIN = ("_source_file", "_source_time")
ROW_ID = "_row_id"


def _reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool):
    return (
        spark.read.option("header", True).option("sep", sep).option("escape", '"').option("encoding", encoding)
        .option("multiLine", multi_line).option("mode", "PERMISSIVE")
    )


def files_by_header(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8", multi_line: bool = False
) -> dict[tuple, list[str]]:
    """The delivered files under each header that occurs: one job, whatever the number of files.

    Encodings other than UTF-8 and headers over several lines are left to Spark's own reader, file by file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    found: dict[tuple, list[str]] = {}
    if encoding.upper().replace("-", "") == "UTF8" and not multi_line:
        for row in sorted(first_lines(spark, paths).collect()):  # as many as a delivery has files
            found.setdefault(header_names(row["header"], sep), []).append(row["file"])
        return found
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")
    for row in listed.orderBy("path").toLocalIterator():
        header = tuple(_reader(spark, sep, encoding, multi_line).csv(row["path"]).columns)
        found.setdefault(header, []).append(row["path"])
    return found


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    corrupt: str | None = None,
    multi_line: bool = False,
    sep: str = ",",
    encoding: str = "UTF-8",
    numbered: bool = False,
) -> DataFrame:
    """CSV files as they are: every column text, nothing inferred or trimmed.

    Each file has the columns of its own header; a question that only some files
    have is NULL in the others. ``columns`` demands one header of all files.
    ``corrupt`` names a column for lines that do not fit the columns. A file with
    line breaks inside quotes needs ``multi_line``; it is read by many tasks, too
    (by one task only in an encoding other than UTF-8). ``numbered`` adds the
    identity of each row, growing along the files, where lines are not read in order.
    """
    if multi_line and encoding.upper().replace("-", "") == "UTF8" and len(sep) == 1:
        return _read_records(spark, path, columns, corrupt, sep, numbered)
    if columns is None:
        groups = files_by_header(spark, path, sep, encoding, multi_line)
    else:
        groups = {tuple(columns): [path] if isinstance(path, str) else list(path)}
    parts = []
    for header, files in groups.items():
        fields = [T.StructField(c, T.StringType()) for c in header]
        if corrupt:
            fields.append(T.StructField(corrupt, T.StringType()))
        # the header of each file must name these columns in this order
        reader = _reader(spark, sep, encoding, multi_line).schema(T.StructType(fields)).option("enforceSchema", False)
        if corrupt:
            reader = reader.option("columnNameOfCorruptRecord", corrupt)
        df = reader.csv(files)
        parts.append(df.select(
            "*", F.col("_metadata.file_path").alias(ORIGIN[0]), F.col("_metadata.file_modification_time").alias(ORIGIN[1])))
    if not parts:
        raise ValueError(f"no files in {path}")
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    last = [c for c in (corrupt, *ORIGIN) if c]
    return whole.select(*[F.col(f"`{c}`") for c in whole.columns if c not in last], *last)


def _read_records(spark, path, columns, corrupt, sep, numbered) -> DataFrame:
    rows, headers = read_records(spark, path, sep, corrupt)
    if not headers:
        raise ValueError(f"no files in {path}")
    if columns is not None and headers != [tuple(columns)]:
        raise ValueError(f"the header is {headers}, not {tuple(columns)}")
    names = list(dict.fromkeys(n for h in headers for n in h))
    return rows.select(
        *[F.col(f"`{c}`") for c in names], *([corrupt] if corrupt else []), F.col("file").alias(ORIGIN[0]), F.col("time").alias(ORIGIN[1]),
        *([F.col("row_id").alias(ROW_ID)] if numbered else []))


def land_bronze(df: DataFrame, lake: Lake, batch_id: int, name: str = "answers") -> str:
    """Keep the raw rows of a batch with the file they came from, its time, and an identity.

    ``df`` comes from ``read_raw``. ``_row_id`` is given once, when the row is
    written, and is unique in its batch. Landing a batch again replaces it.
    """
    if ROW_ID not in df.columns:
        df = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    return write_batch(df, lake, name, batch_id)


def trace(silver: DataFrame, bronze: DataFrame, keys: DataFrame | Sequence[int] | None = None) -> DataFrame:
    """Each silver row with the raw row it was made from; raw columns get ``raw_``.

    Rows that carry their identity meet exactly one raw row; without it, all of the
    key's raw rows in the batch.

    ``keys`` limits the rows asked for: a list, or a DataFrame with ``resp_id``.
    """
    if isinstance(keys, DataFrame):
        silver = silver.join(keys.select("resp_id").distinct(), "resp_id", "left_semi")
    elif keys is not None:
        silver = silver.filter(F.col("resp_id").isin(*keys))
    exact = ROW_ID in silver.columns and ROW_ID in bronze.columns
    same = ["_batch_id", ROW_ID] if exact else ["resp_id", "_batch_id"]
    key = F.trim(F.col("resp_id").cast("string")).try_cast("bigint").alias("resp_id")
    raw = bronze.select(
        *([] if exact else [key]), *same[-1:] if not exact else same,
        *[
            F.col(f"`{c}`").alias(c if c in ORIGIN else f"raw_{c}")
            for c in bronze.columns if c not in ("_batch_id", ROW_ID)
        ],
    )
    return silver.join(raw, same)
