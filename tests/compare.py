"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty when both engines agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected_rows = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    cols = sorted(df.columns)
    problems = []
    if cols != sorted(names):
        return [f"columns: {cols} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    order = [names.index(c) for c in cols]
    want = Counter(tuple(_norm(row[i]) for i in order) for row in expected_rows)
    got = Counter(tuple(_norm(row[c]) for c in cols) for row in df.collect())
    extra, missing = got - want, want - got
    if extra or missing:
        problems.append(f"rows: spark {sum(got.values())}, duckdb {sum(want.values())}, {sum(extra.values())} differ")
        problems += [f"  only spark  {dict(zip(cols, r))}" for r in list(extra)[:3]]
        problems += [f"  only duckdb {dict(zip(cols, r))}" for r in list(missing)[:3]]
    return problems
