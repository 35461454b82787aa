"""Text to typed values. A value that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from surveylake.functions.text import _col, key_of, text_key, tidy
from surveylake.rules import DATE_FORMAT, YES_NO


def to_int(c: Column | str, type_: str = "bigint") -> Column:
    return F.trim(_col(c)).try_cast(type_)


def to_money(c: Column | str, type_: str = "decimal(12,2)", point: str = ",") -> Column:
    """``R$ 1.234,56`` to 1234.56: groups of three after dots, at most two decimals after the comma.

    Anything else (``1234.56``, ``1.2.3``, ``1,239``) is unreadable, never a guess. ``point="."``
    is for a column whose point is the dot and whose groups are parted by commas.
    """
    group = "." if point == "," else ","
    # most amounts are bare digits: one short pattern tells, and the forms below are for the rest
    raw = _col(c)
    bare = raw.rlike(rf"^[0-9]+(?:[{point}][0-9]{{1,2}})?$")
    text = F.upper(tidy(c))
    form = rf"^[+-]?(R\$ ?)?[+-]?(\d+|\d{{1,3}}([{group}]\d{{3}})+)([{point}]\d{{1,2}})?$"
    number = F.translate(text, f"{point}{group}R$ ", ".")  # of a text in that form: the point stays, the rest goes
    return F.when(bare, F.replace(raw, F.lit(point), F.lit(".")).try_cast(type_)).when(text.rlike(form), number.try_cast(type_))


def to_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(F.trim(_col(c)), fmt)


def from_map(key: Column, mapping: Mapping[str, object]) -> Column:
    """Look a key up in a small map kept in the plan; unknown keys give NULL."""
    if not mapping:
        return F.lit(None)
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def to_flag(c: Column | str, mapping: Mapping[str, bool] = YES_NO) -> Column:
    return from_map(text_key(c), {key_of(k): v for k, v in mapping.items()})
