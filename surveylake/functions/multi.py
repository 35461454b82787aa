"""Many-choice answers kept as one text or one array per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from surveylake.functions.text import _col, tidy
from surveylake.rules import MISSING_WORDS, MULTI_SEP


def split_list(c: Column | str, sep: str = MULTI_SEP) -> Column:
    """``'b; a;b'`` to ``['A', 'B']``: upper case, no repeats, no missing words, sorted; empty is NULL."""
    # built-in array functions without a lambda, so the whole stays in generated code
    text = F.upper(tidy(c))
    if len(sep) == 1 and sep != " ":
        # one blank at most is left on each side, and a single character is found without a pattern
        for around in (f" {sep}", f"{sep} "):
            text = F.replace(text, F.lit(around), F.lit(sep))
        parts = F.split(text, re.escape(sep))
    else:
        parts = F.split(text, f" *{re.escape(sep)} *")
    nothing = F.array(*[F.lit(x.upper()) for x in dict.fromkeys(("", *MISSING_WORDS))])
    parts = F.sort_array(F.array_except(parts, nothing))
    return F.nullif(parts, F.array().cast("array<string>"))


def join_list(c: Column | str, sep: str = MULTI_SEP) -> Column:
    """The opposite of ``split_list``; NULL stays NULL."""
    return F.array_join(_col(c), sep)


def list_size(c: Column | str) -> Column:
    """Number of entries; 0 for NULL whatever the ANSI setting is."""
    return F.coalesce(F.array_size(_col(c)), F.lit(0))
