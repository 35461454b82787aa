"""Invalid values: out of range, outside a domain, unusable keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from surveylake.operators.issues import replace_value


def check_range(
    df: DataFrame, col: str, lo=None, hi=None, action: str = "null", lo_open: bool = False
) -> DataFrame:
    """Numbers outside [lo, hi] (or (lo, hi] with ``lo_open``).

    ``action``: ``null`` empties the value, ``clamp`` moves it to the bound,
    ``flag`` leaves it. All three note the column in ``issues``.
    """
    c, bad = F.col(col), F.lit(False)
    if lo is not None:
        bad = bad | ((c <= F.lit(lo)) if lo_open else (c < F.lit(lo)))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    bad = F.coalesce(bad, F.lit(False))
    if action == "null":
        value = F.when(~bad, c)
    elif action == "clamp":
        if lo_open:
            raise ValueError("an open bound is not a value to clamp to")
        value = c
        # greatest and least skip NULL, so a missing number must be kept apart
        if lo is not None:
            value = F.greatest(value, F.lit(lo))
        if hi is not None:
            value = F.least(value, F.lit(hi))
        value = F.when(c.isNotNull(), value).cast(df.schema[col].dataType)
    elif action == "flag":
        value = c
    else:
        raise ValueError(f"action must be 'null', 'clamp' or 'flag', not {action!r}")
    return replace_value(df, col, value, bad)


def check_domain(
    df: DataFrame,
    col: str,
    allowed: Iterable | DataFrame | None = None,
    regex: str | None = None,
) -> DataFrame:
    """Values outside a list, or not matching a pattern, to NULL and an issue.

    ``allowed`` may be a DataFrame with the column ``col``; it is made distinct
    and joined, and Spark decides from its size how.
    """
    c = F.col(col)
    if isinstance(allowed, DataFrame):
        known = (
            allowed.filter(c.isNotNull()).select(c.alias("_allowed")).distinct()
        )
        joined = df.join(known, c == F.col("_allowed"), "left")
        bad = c.isNotNull() & F.col("_allowed").isNull()
        return replace_value(joined, col, F.when(~bad, c), bad).drop("_allowed")
    ok: Column = F.lit(True)
    if allowed is not None:
        ok = ok & c.isin(*allowed)
    if regex is not None:
        ok = ok & c.rlike(regex)
    bad = c.isNotNull() & ~ok
    return replace_value(df, col, F.when(~bad, c), bad)


def _typed_key(key: str, type_: str) -> Column:
    return F.trim(F.col(key).cast("string")).try_cast(type_)


def usable_key(keys: Sequence[str], type_: str = "bigint") -> Column:
    """True where every key column holds a value that can be read as ``type_``."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & _typed_key(k, type_).isNotNull()
    return ok


def split_quarantine(
    df: DataFrame, keys: Sequence[str], type_: str = "bigint"
) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable key, the key now typed, and the rest as they came."""
    ok = usable_key(keys, type_)
    typed = {k: _typed_key(k, type_) for k in keys}
    return df.filter(ok).withColumns(typed), df.filter(~ok)


def quarantine_report(
    df: DataFrame, keys: Sequence[str], content: Sequence[str], type_: str = "bigint"
) -> DataFrame:
    """One row: rows, rows without key, keys, repeated rows, keys whose copies differ.

    Copies of a key are reduced to the smallest and the largest of their contents
    before the shuffle, so a key with very many copies costs no more than another.
    """
    row = F.struct(*content)
    key = F.struct(*[_typed_key(k, type_).alias(k) for k in keys])
    ok = usable_key(keys, type_)
    per_key = df.groupBy(F.when(ok, key).alias("k")).agg(
        F.count("*").alias("n"), F.min(row).alias("first"), F.max(row).alias("last")
    )
    keyed = F.col("k").isNotNull()
    zero = F.lit(0)
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(~keyed, F.col("n"))), zero).alias("without_key"),
        F.count_if(keyed).alias("keys"),
        F.coalesce(F.sum(F.when(keyed, F.col("n") - 1)), zero).alias("repeated"),
        F.count_if(keyed & (F.col("first") != F.col("last"))).alias("differing_keys"),
    )
