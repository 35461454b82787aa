"""Stored counts of answers, from which all gold tables follow.

A cell is a distinct combination of the answers to some questions within one edition,
with the number of answers that have it. Cells of an edition depend on that edition
alone and add up over editions, so a changed edition replaces its own cells and nothing
else. A gold table reads the narrowest cells with its questions: silver is read once per
family and edition, not once per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from surveylake.operators.sketches import distinct_sketches
from surveylake.operators.weights import WEIGHT, counted
from surveylake.plans.fronts import GOLD_COLUMNS, GOLD_TABLES
from surveylake.rules import TECH_CATEGORIES

_PEOPLE = ("role", "region", "state", "seniority", "work_model", "ai_use")
_TECH = tuple(TECH_CATEGORIES)

#: Questions of each family; a table reads the first that has all of its own. Every family has the edition, too.
FAMILIES: dict[str, tuple[str, ...]] = {
    "cells_people": _PEOPLE,
    "cells_pay": ("role", "region", "seniority", "seniority_rank", "work_model", "ai_use", "pay", "pay_band"),
    "cells_pay_state": ("state", "pay"),
    "cells_tech": (*_PEOPLE, "n_tools", *_TECH),
    "cells_pay_tech": ("pay", *_TECH),
}


#: Columns whose distinct values are kept per edition, as sketches.
SKETCHES, SKETCHED = "sketches", ("resp_id", "role", "region", "state", "pay")
#: What is stored per edition.
STORED = (*FAMILIES, SKETCHES)


def family(table: str) -> str:
    """The first family with all questions of a gold table."""
    wanted = set(GOLD_COLUMNS[table]) - {"edition"}
    return next(name for name, columns in FAMILIES.items() if wanted <= set(columns))


def needed(tables: Iterable[str]) -> list[str]:
    """What must be stored per edition for some gold tables, and the sketches."""
    wanted = {family(t) for t in tables}
    return [name for name in STORED if name in wanted or name == SKETCHES]


def cells(answers: DataFrame, name: str) -> DataFrame:
    """The cells of a family: one scan of its columns, combined before the shuffle."""
    return counted(answers, ["edition", *FAMILIES[name]])


def stored(answers: DataFrame, name: str) -> DataFrame:
    """What is kept of the answers of some editions under a name of ``STORED``."""
    return distinct_sketches(answers, ["edition"], SKETCHED) if name == SKETCHES else cells(answers, name)


def from_cells(table: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """A gold table from stored cells; ``read`` gives the cells of a family."""
    kept = read(family(table)).select(*GOLD_COLUMNS[table], F.col(WEIGHT))
    return GOLD_TABLES[table](kept)
