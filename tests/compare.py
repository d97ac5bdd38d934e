"""Row-by-row comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(([_plain(r[i]) for i in order] for r in rows), key=lambda r: [v or "" for v in r])


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when both results hold the same columns and the same rows."""
    result = con.execute(sql)
    names, expected = _rows([d[0] for d in result.description], result.fetchall())
    found_names, found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != found_names:
        return [f"columns {found_names} instead of {names}"]
    out = [] if len(found) == len(expected) else [f"{len(found)} rows instead of {len(expected)}"]
    bad = [(f, e) for f, e in zip(found, expected) if f != e]
    if bad:
        out.append(f"{len(bad)} rows differ")
        out += [f"  found    {dict(zip(names, f))}\n  expected {dict(zip(names, e))}" for f, e in bad[:limit]]
    return out
