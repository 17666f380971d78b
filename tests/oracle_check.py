"""Compare a Spark result with the DuckDB result of the same query."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


def differences(df, con, sql: str, limit: int = 5) -> list[str]:
    """Empty if columns, types and rows agree."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: _KINDS.get(str(c[1]), str(c[1])) for c in result.description}
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for name, kind in df.dtypes:
        if kinds[name] != kind:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    ours = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = normal_rows(columns, result.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    names = sorted(columns)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, columns {names}")
        problems += [f"{a} != {b}" for a, b in wrong[:limit]]
    return problems
