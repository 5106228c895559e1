"""Runs a registered query and its checking SQL and compares the rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, Decimal):
        return ("dec", v.normalize() + 0)
    if isinstance(v, float):
        return ("dbl", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None))
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


KIND = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "smallint": "SMALLINT",
}


def compare(df, con, sql: str):
    """None when equal, else a short description."""
    result = con.execute(sql)
    described = [(d[0], str(d[1])) for d in result.description]
    theirs_cols, theirs = _bag([d[0] for d in described], result.fetchall())
    ours_cols, ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    if ours_cols != theirs_cols:
        return f"columns {set(ours_cols) ^ set(theirs_cols)}"
    types = dict(described)
    wrong = {
        f.name: (f.dataType.simpleString(), types[f.name])
        for f in df.schema
        if KIND.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) != types[f.name].upper().replace(" ", "")
    }
    if ours != theirs:
        a, b = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        return f"{sum(ours.values())} vs {sum(theirs.values())} rows; {ours_cols}\n   spark {a}\n   sql   {b}; types {wrong}"
    if wrong:
        return f"types {wrong}"
    return None if theirs else "empty"
