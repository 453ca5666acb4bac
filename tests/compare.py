"""Runs a registered query and its oracle and compares schema and rows."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

# DuckDB type of each Spark type in a result
SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("set threads = 4")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _order(row):
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def differences(frame, con, sql: str) -> list[str]:
    """Empty if the Spark frame equals the oracle; otherwise what differs."""
    names = sorted(frame.columns)
    relation = con.sql(sql)
    problems = []
    if sorted(relation.columns) != names:
        return [f"columns {names} vs {sorted(relation.columns)}"]
    spark_types = dict(frame.dtypes)
    duck_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    for c in names:
        if SAME_TYPE.get(spark_types[c]) != duck_types[c]:
            problems.append(f"type of {c}: {spark_types[c]} vs {duck_types[c]}")
    ours = [tuple(_plain(r[c]) for c in names) for r in frame.select(*names).collect()]
    quoted = ", ".join(f'"{c}"' for c in names)
    theirs = [
        tuple(_plain(v) for v in row)
        for row in con.sql(f"select {quoted} from ({sql}) as q").fetchall()
    ]
    ours.sort(key=_order)
    theirs.sort(key=_order)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        problems.append(f"{len(unequal)} unequal rows of {names}, first: {unequal[0]}")
    if not ours:
        problems.append("no rows")
    return problems
