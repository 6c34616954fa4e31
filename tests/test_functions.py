"""Column expressions of spanpack.functions, evaluated row by row."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spanpack.functions import (
    covered_days,
    days_between,
    drug_end_date,
    drug_end_source,
    gap_days_covered,
    gap_days_stockpile,
    opens_new_run,
)

BASE = dt.date(2021, 1, 1)


def d(n):
    return None if n is None else BASE + dt.timedelta(days=n)


@pytest.mark.parametrize("start,prev,grace,expected", [
    (40, 10, 30, False),   # gap exactly 30 joins
    (41, 10, 30, True),    # gap 31 opens
    (10, 10, 0, False),    # touching joins with grace 0
    (11, 10, 0, True),
    (5, None, 30, True),   # first record of a key
    (5, 100, 30, False),   # inside a running maximum
])
def test_opens_new_run(spark, start, prev, grace, expected):
    df = spark.createDataFrame([(d(start), d(prev))], "s date, p date")
    assert df.select(opens_new_run("s", F.col("p"), grace).alias("x")).first().x is expected


@pytest.mark.parametrize("start,end,prev,expected", [
    (0, 10, None, 10),     # nothing before
    (5, 10, 8, 2),         # partly covered already
    (5, 10, 20, 0),        # fully covered already
    (30, 40, 10, 10),      # after a hole: the hole is not counted
    (5, 5, None, 0),       # zero length
])
def test_covered_days(spark, start, end, prev, expected):
    df = spark.createDataFrame([(d(start), d(end), d(prev))], "s date, e date, p date")
    assert df.select(covered_days("s", "e", F.col("p")).alias("x")).first().x == expected


def test_gap_and_length_helpers(spark):
    df = spark.createDataFrame([(d(0), d(70), 70, 50)], "s date, e date, summed long, covered long")
    r = df.select(
        days_between("s", "e").alias("n"),
        gap_days_stockpile("s", "e", "summed").alias("g1"),
        gap_days_covered("s", "e", "covered").alias("g2"),
    ).first()
    assert (r.n, r.g1, r.g2) == (70, 0, 20)


def test_drug_end_rules_and_source(spark):
    rows = [(d(0), d(5), 30), (d(0), None, 7), (d(0), None, 0), (d(0), None, None), (d(0), None, -3)]
    df = spark.createDataFrame(rows, "s date, e date, supply int")
    got = [(r.end, r.src) for r in df.select(
        drug_end_date("s", "e", "supply", 1).alias("end"), drug_end_source("e", "supply").alias("src")
    ).collect()]
    assert got == [(d(5), "given"), (d(7), "supply"), (d(1), "default"), (d(1), "default"), (d(-3), "supply")]
