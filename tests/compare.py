"""Runs a query on Spark and its SQL on DuckDB over the same tables, and compares."""

from __future__ import annotations

import glob
import os

import duckdb

KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(columns: list, dtypes: list, got: list, con, text: str) -> list[str]:
    result = con.execute(text)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    out = []
    if sorted(columns) != sorted(names):
        return [f"columns {sorted(columns)} / {sorted(names)}"]
    for name, kind in dtypes:
        if KINDS.get(kind) != kinds[name]:
            out.append(f"type of {name}: {kind} / {kinds[name]}")
    if len(got) != len(want):
        out.append(f"rows: {len(got)} / {len(want)}")
    pairs = zip(_sorted(columns, got), _sorted(names, want))
    bad = [(a, b) for a, b in pairs if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {bad[0][0]} / {bad[0][1]}")
    return out
