"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v + 0.0, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when both sides agree."""
    relation = con.sql(sql)
    expected_columns, expected = relation.columns, relation.fetchall()
    actual = df.collect()
    if sorted(df.columns) != sorted(expected_columns):
        return [f"columns {sorted(df.columns)} != {sorted(expected_columns)}"]
    a, b = canonical(df.columns, actual), canonical(expected_columns, expected)
    if len(a) != len(b):
        return [f"rows {len(a)} != {len(b)}"] + [f"{x} / {y}" for x, y in zip(a, b) if x != y][:limit]
    return [f"{x} / {y}" for x, y in zip(a, b) if x != y][:limit]
