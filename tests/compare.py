"""Compare a Spark result with the checking SQL as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str:
    """Empty when both agree in columns and rows."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours, theirs = bag(df.columns, rows), bag(names, expected)
    if ours != theirs:
        return f"{len(rows)} and {len(expected)} rows; ours only {list((ours - theirs).items())[:2]}; theirs only {list((theirs - ours).items())[:2]}"
    return ""
