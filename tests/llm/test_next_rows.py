"""The next row by id, and the ranges that rows are dealt to."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spanpack.llm import sketches


def plain_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]), reverse=True)
    return sorted(((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)), key=str)


def spreads(rnd):
    tie = lambda: rnd.randrange(-(2**63), 2**63)
    yield "dense", [(i, tie()) for i in range(900)]
    yield "an outlier", [(i, tie()) for i in range(899)] + [(2**62, tie())]
    yield "dense beside hashed", [(i, tie()) for i in range(450)] + [(tie(), tie()) for _ in range(450)]
    yield "a third without id", [(i if i % 3 else None, tie()) for i in range(900)]
    yield "a third with one id", [(i if i % 3 else 77, tie()) for i in range(900)]
    yield "extremes", [(2**63 - 1, tie()) for _ in range(20)] + [(-(2**63), tie()) for _ in range(20)] + [(None, tie()) for _ in range(20)] + [(0, tie())]
    yield "one row", [(5, tie())]
    yield "no id at all", [(None, tie()) for _ in range(300)]


@pytest.mark.parametrize("name,rows", list(spreads(random.Random(8))), ids=lambda x: x if isinstance(x, str) else "")
def test_next_rows_and_even_ranges(spark, name, rows):
    df = spark.createDataFrame(rows, "id long, tie long").repartition(4).withColumn("v", F.col("tie"))
    got = sketches.with_next(df, ["v"], "id", "tie", per_part=30)
    assert sorted(((r["id"], r["tie"], r["next_v"]) for r in got.collect()), key=str) == plain_next(rows)
    if len(rows) >= 300:
        counts = [r["count"] for r in df.groupBy(sketches.range_parts(df, "id", "tie", 30).alias("p")).count().collect()]
        assert sum(counts) == len(rows) and max(counts) <= 2 * 30 + 1, sorted(counts)


def test_rows_that_repeat_and_none(spark):
    rows = [(1, 5)] * 40 + [(2, 6)] + [(None, 7)] * 3
    df = spark.createDataFrame(rows, "id long, tie long").withColumn("v", F.col("tie"))
    got = sketches.with_next(df, ["v"], "id", "tie", per_part=4)
    assert sorted(((r["id"], r["tie"], r["next_v"]) for r in got.collect()), key=str) == plain_next(rows)
    assert sketches.with_next(df.where("false"), ["v"], "id", "tie").count() == 0
