"""Categories: many spellings to one label and a rank."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from surveylake.functions import key_of, text_key
from surveylake.operators.issues import convert

def mapping_from_rows(rows: Iterable[tuple]) -> dict:
    """``(key, label[, rank])`` rows to a map; a key given twice is refused."""
    out: dict = {}
    for key, *value in rows:
        if key in out:
            raise ValueError(f"key {key!r} is given twice")
        out[key] = tuple(value) if len(value) > 1 else value[0]
    return out


def _rows(mapping: Mapping) -> list[tuple]:
    """(key in text form, label, rank) of each entry; two keys that become one are refused."""
    out: dict = {}
    for key, value in mapping.items():
        label, rank = value if isinstance(value, tuple) else (value, None)
        if key_of(key) in out:
            raise ValueError(f"category key given twice: {key_of(key)!r}")
        out[key_of(key)] = (label, rank)
    return [(key, label, rank) for key, (label, rank) in out.items()]


def lookup_table(spark: SparkSession, mapping: Mapping | DataFrame) -> DataFrame:
    """``_key, _label, _rank``, one row per key in text form; a repeated key stops the job instead of doubling answers."""
    if not isinstance(mapping, DataFrame):
        rows = _rows(mapping)
        keys, labels, ranks = zip(*rows) if rows else ((), (), ())
        kind = pa.bool_() if rows and all(isinstance(x, bool) for x in labels) else pa.string()
        # an Arrow table is part of the plan, so Spark knows its size
        return spark.createDataFrame(pa.table({
            "_key": pa.array(keys, pa.string()), "_label": pa.array(labels, kind), "_rank": pa.array(ranks, pa.int32()),
        }))
    rank = F.col("rank").cast("int") if "rank" in mapping.columns else F.lit(None).cast("int")
    once = F.count("*") == 1
    twice = F.raise_error(F.concat(F.lit("category key given twice: "), F.col("_key")))
    return (
        mapping.filter(F.col("key").isNotNull())
        .groupBy(text_key("key").alias("_key"))
        .agg(
            F.when(once, F.max("label")).otherwise(twice).alias("_label"),
            F.max(rank).alias("_rank"),
        )
    )


def map_category(
    df: DataFrame, col: str, mapping: Mapping | DataFrame, rank_col: str | None = None
) -> DataFrame:
    """Set ``col`` to its label; an unknown spelling becomes NULL and an issue.

    ``mapping`` is ``{key: label}``, ``{key: (label, rank)}`` or a DataFrame
    ``key, label[, rank]``. All mean the same: keys are compared in text form, the
    rank is that of the key, and the map is left joined, in the way that its size
    lets Spark choose.
    """
    table = lookup_table(df.sparkSession, mapping)
    joined = df.join(table, text_key(col) == F.col("_key"), "left")
    if rank_col:
        joined = joined.withColumn(rank_col, F.col("_rank"))
    return convert(joined, col, F.col("_label")).drop("_key", "_label", "_rank")


def unmapped(df: DataFrame, col: str, mapping: Mapping | DataFrame) -> DataFrame:
    """Spellings the map does not know, with the number of answers.

    Spellings are counted first, so only distinct ones are compared with the map.
    """
    seen = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    known = lookup_table(df.sparkSession, mapping).select("_key")
    return seen.join(known, text_key(col) == F.col("_key"), "left_anti")
