"""The plan that was really run, as text, without the initial plans next to it."""

from __future__ import annotations

import re


def final_plan(df) -> str:
    """``df`` must have been collected."""
    return _final(df._jdf.queryExecution().executedPlan().toString())


def _depth(line: str) -> int:
    return len(re.match(r"[\s:|+\-]*", line).group())


def _final(text: str) -> str:
    out, skip = [], None
    for line in text.splitlines():
        depth = _depth(line)
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def scans(plan: str, table: str) -> int:
    return sum("FileScan" in line and f"/{table}.parquet" in line for line in plan.splitlines())
