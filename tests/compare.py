"""Compare a Spark result with the same query in DuckDB: names, number and values of the rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return repr(float(value)) if isinstance(value, float) else int(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def differences(df, con, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    expected = Counter(tuple(_plain(row[names.index(c)]) for c in order) for row in cursor.fetchall())
    found = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; columns {order}; "
        f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    )
