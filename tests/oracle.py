"""Compare named queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def normalise(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(cells, key=repr)


_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con, sql: str) -> str | None:
    """None when names, types and rows agree; otherwise what differs."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in df.dtypes:
        if _TYPES.get(kind, kind) != types.get(name):
            return f"type of {name}: {kind} != {types.get(name)}"
    names, rows = normalise([d[0] for d in result.description], result.fetchall())
    got_names, got = normalise(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} != {names}"
    if len(rows) != len(got):
        return f"{len(got)} rows != {len(rows)}"
    for mine, theirs in zip(got, rows):
        if mine != theirs or [type(a) for a in mine] != [type(b) for b in theirs]:
            return f"{mine} != {theirs}"
    return None
