"""What the operators share: scratch tables, byte-level words, Arrow columns."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z, every other byte unchanged.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="surveylake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/surveylake-{uuid.uuid4().hex}"


def save(df: DataFrame, *apart: str) -> DataFrame:
    """The same rows, written to scratch and read again: lineage ends, sizes are known.

    Rows that differ in the columns ``apart`` get files of their own, so that a reader of some does not load the others.
    """
    path = scratch(df.sparkSession)
    (df.write.partitionBy(*apart) if apart else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def boxed(docs: DataFrame, *own: Column) -> DataFrame:
    """``own`` columns beside ``_input``, which holds all columns of ``docs`` but ``text``: no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("_input"), *own)


def unboxed(rows: DataFrame, docs: DataFrame, *more: Column) -> DataFrame:
    """The columns of ``docs`` again, ``text`` being that of ``rows``, and ``more``."""
    return rows.select(*[F.col("text") if c == "text" else F.col(f"_input.`{c}`") for c in docs.columns], *more)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs``, written with a number per row, so that rows without an id and repeated rows can be told apart."""
    return save(docs.withColumn(name, F.monotonically_increasing_id()))


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than 0x09-0x0D and 0x20."""
    return text.split()


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of each text; NULL is empty."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def kept() -> dict[str, Any]:
    """What steps keep in this worker from task to task; functions come to workers by value, so it hangs on a module of its own."""
    return sys.modules.setdefault("_surveylake_worker", types.ModuleType("_surveylake_worker")).__dict__.setdefault("kept", {})


def trim() -> None:
    """Gives free memory back to the system."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if give:
        give(0)


def released(run: Callable, keeps: str = "") -> Callable:
    """``run`` for ``mapInArrow``; at its end the worker, which Spark keeps for other tasks, gives free memory back.

    What other steps kept in the worker is dropped first, all but the cache ``keeps``.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [name for name in kept() if name != keeps]
        for name in others:
            del kept()[name]
        if others:
            trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """A cache that outlives a task, as Spark keeps its Python workers, until one of another ``released`` step comes."""
    if name not in kept():
        kept()[name] = make()
    return kept()[name]
