"""Compare registered queries with their SQL on DuckDB: names, rows and values."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(frame, con, sql: str) -> list[str]:
    found = frame.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = dict(zip(names, (str(d[1]) for d in cursor.description)))
    wanted = cursor.fetchall()
    problems = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    ours, theirs = canonical(frame.columns, found), canonical(names, wanted)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    for name, kind in frame.dtypes:
        if kind in SAME_TYPES and kinds[name] != SAME_TYPES[kind]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    return problems
