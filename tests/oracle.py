"""Run a registered Spark query and its DuckDB oracle; compare results as multisets."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()))
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("t", v.isoformat())
    return ("s", v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((x is None, repr(x)) for x in r),
    )
    return cols, out


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    s_cols, s_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_cols, d_rows = canonical(d_cols, res.fetchall())
    if s_cols != d_cols:
        return False, f"{name}: columns differ spark={s_cols} oracle={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows spark={len(s_rows)} oracle={len(d_rows)}"
    if s_rows != d_rows:
        diff = next(i for i, (a, b) in enumerate(zip(s_rows, d_rows)) if a != b)
        return False, f"{name}: first diff spark={s_rows[diff]} oracle={d_rows[diff]}"
    return True, f"{name}: {len(s_rows)} rows match"
