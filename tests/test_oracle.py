"""Every registered query against its DuckDB oracle (sf0.001 by default)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from conftest import SF0001
from oracle import compare, duck

SF = os.environ.get("SPANPACK_ORACLE_SF", SF0001)
# the training-data operators have tests of their own
QUERIES = {n: q for n, q in E.queries().items() if not n.startswith("op") and n != "pipeline"}
SQL = {n: q for n, q in E.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], SQL[name], SF, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "person_id", "drug_concept_id", "drug_era_start_date", "drug_era_end_date",
        "drug_exposure_count", "drug_exposure_count_stockpile", "gap_days_stockpile", "gap_days_covered",
    ]
    assert df.count() == 6033


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "decimal(18,2)": "DECIMAL(18,2)", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, con, name):
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in QUERIES[name](spark, SF).dtypes}
    rel = con.sql(SQL[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
