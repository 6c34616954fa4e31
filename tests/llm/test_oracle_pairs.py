"""Queries that SQL can express, against DuckDB on the small tables."""

from __future__ import annotations

import duckdb
import pytest
from tests_paths import SF0001

from spanpack.llm import queries

SF = SF0001.replace("0.001", "0.01")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = sorted(c[0] for c in want.description)
    order = sorted(range(len(columns)), key=lambda i: want.description[i][0])
    rows = sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == rows and rows
