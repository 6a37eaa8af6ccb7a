"""Compare a Spark result with the same answer from DuckDB, ignoring row order."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(frame, con, sql: str) -> list[str]:
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    expected = answer.fetchall()
    found = [tuple(row) for row in frame.collect()]
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
        return problems
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows != {len(expected)}")
    a, b = _rows(frame.columns, found), _rows(names, expected)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        problems.append(f"values differ: spark {only_a} sql {only_b}")
    return problems
