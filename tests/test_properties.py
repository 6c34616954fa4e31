"""Property tests: random valid intervals against the brute-force model."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from model import pack
from spanpack import summarize_eras
from spanpack.functions import gap_days_covered, gap_days_stockpile

BASE = dt.date(2021, 3, 1)
SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType()),
    T.StructField("s", T.DateType()),
    T.StructField("e", T.DateType()),
])

interval = st.tuples(st.integers(0, 4), st.integers(0, 300), st.integers(0, 45))
datasets = st.lists(interval, min_size=1, max_size=120)


def spark_eras(spark, rows, grace):
    df = spark.createDataFrame(
        [(k, BASE + dt.timedelta(days=s), BASE + dt.timedelta(days=s + n)) for k, s, n in rows], SCHEMA
    ).repartition(3)
    e = summarize_eras(df, ["k"], "s", "e", grace)
    out = e.select(
        "k", "era_start", "era_end", "record_count",
        gap_days_stockpile("era_start", "era_end", "sum_days").alias("g1"),
        gap_days_covered("era_start", "era_end", "covered_days").alias("g2"),
    ).collect()
    return sorted(
        (r.k, (r.era_start - BASE).days, (r.era_end - BASE).days, r.record_count, r.g1, r.g2) for r in out
    )


def model_eras(rows, grace):
    by_key = defaultdict(list)
    for k, s, n in rows:
        by_key[k].append((s, s + n))
    return sorted((k, *era) for k, iv in by_key.items() for era in pack(iv, grace))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=datasets, grace=st.sampled_from([0, 2, 30]))
def test_matches_brute_force(spark, rows, grace):
    got = spark_eras(spark, rows, grace)
    assert got == model_eras(rows, grace)
    # invariants
    assert sum(r[3] for r in got) == len(rows)
    assert all(r[5] >= 0 and r[4] <= r[5] for r in got)
    by_key = defaultdict(list)
    for k, s, e, *_ in got:
        by_key[k].append((s, e))
    for eras in by_key.values():
        eras.sort()
        assert all(b[0] > a[1] + grace for a, b in zip(eras, eras[1:]))


def test_repacking_eras_is_a_no_op(spark):
    rows = [(k, (i * 37) % 250, (i * 11) % 40) for i in range(300) for k in range(3)]
    df = spark.createDataFrame(
        [(k, BASE + dt.timedelta(days=s), BASE + dt.timedelta(days=s + n)) for k, s, n in rows], SCHEMA
    )
    first = summarize_eras(df, ["k"], "s", "e", 30).select("k", F.col("era_start").alias("s"), F.col("era_end").alias("e"))
    again = summarize_eras(first, ["k"], "s", "e", 30).select("k", F.col("era_start").alias("s"), F.col("era_end").alias("e"))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_hot_key_on_one_day_is_collapsed_before_the_window(spark):
    """A third of all rows on one key and one start day: exact results."""
    hot = [(0, 10, (i % 50)) for i in range(2000)]
    cold = [(k, (k * 13) % 200, 5) for k in range(1, 4001)]
    rows = hot + cold
    got = spark_eras(spark, rows, 30)
    assert got == model_eras(rows, 30)
