"""Compare a registered query with its SQL in DuckDB, row for row."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def differences(df, con, sql: str, show: int = 3) -> list[str]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _sorted_rows(result.fetchall(), columns)
    mine = _sorted_rows([tuple(r) for r in df.collect()], df.columns)
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} != {len(theirs)}", f"{mine[:show]}", f"{theirs[:show]}"]
    return [f"{a} != {b}" for a, b in zip(mine, theirs, strict=True) if a != b][:show]
