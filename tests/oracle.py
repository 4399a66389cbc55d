"""Compare a registered query with its SQL twin on the same parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), _rows(columns, cur.fetchall())


def differences(df, con, sql) -> str | None:
    cols_a, a = spark_rows(df)
    cols_b, b = duck_rows(con, sql)
    if cols_a != cols_b:
        return f"columns differ: {cols_a} vs {cols_b}"
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return f"rows differ: {len(a)} vs {len(b)}; spark only {only_a}; sql only {only_b}"
    return None
