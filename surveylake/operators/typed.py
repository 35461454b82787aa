"""Text columns to typed columns, and the schema contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from surveylake.functions import to_date, to_flag, to_int, to_money
from surveylake.operators.issues import convert
from surveylake.rules import DATE_FORMAT


def to_type(df: DataFrame, col: str, type_: str) -> DataFrame:
    """Text to an integer or boolean type; unreadable text becomes NULL and an issue."""
    value = to_flag(col) if type_ == "boolean" else to_int(col, type_)
    return convert(df, col, value)


def to_decimal_br(df: DataFrame, col: str, type_: str = "decimal(12,2)") -> DataFrame:
    return convert(df, col, to_money(col, type_))


def to_date_fmt(df: DataFrame, col: str, fmt: str = DATE_FORMAT) -> DataFrame:
    return convert(df, col, to_date(col, fmt))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the contract, in its order and types; extra columns go.

    A missing column is refused here, while the plan is built. Text is read with
    ``try_cast``, so a bad value is NULL; other types must widen safely.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the data: {missing}")
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    cast = {
        f.name: F.trim(F.col(f.name)).try_cast(f.dataType)
        for f in schema
        if f.name in text and not isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(cast).to(schema) if cast else df.to(schema)
