"""Work by key over stored tables: records of light keys move once, by their keys."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF0001
from spanpack import attach_run_ends, drug_era, drug_target, summarize_eras
from spanpack.operators import split_by_weight
from spanpack.operators.packing import era_end_dates
from spanpack.operators.quality import record_counts
from spanpack.operators.spread import PARTS
from spanpack.plans.inspect import scan_details
from spanpack.sources import fixtures as fx

DAY0 = date(2020, 1, 1)
KEYS = ["k", "g"]


def _records(seed=1, keys=1500):
    """Two heavy keys, one of them on one day, and many light ones; copies, ids
    under two ends and types, and rows without a key, a start or an end."""
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        for _ in range(400 if k == 7 else rng.choice([1, 1, 2])):
            s = DAY0 + timedelta(days=rng.randrange(400))
            rows.append((k, "ab"[k % 2], rng.randrange(300), rng.choice("xyz"), s, s + timedelta(days=rng.choice([0, 3, 70, 200]))))
    rows += [(8, "a", i % 90, "x", DAY0, DAY0 + timedelta(days=i % 5)) for i in range(300)]
    rows += rows[::40] + [(None, "a", 1, "x", DAY0, DAY0), (3, None, 1, "x", DAY0, DAY0), (4, "a", 1, "x", None, DAY0), (5, "b", None, None, DAY0, DAY0), (6, "a", 2, "x", DAY0, None)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, g string, id int, t string, s date, e date")


def _rows(df, columns=None):
    return Counter(map(tuple, df.select(*(columns or df.columns)).collect()))


def test_no_light_key_has_more_than_its_share(spark):
    rows = _records()
    df, other = _frame(spark, rows), spark.createDataFrame([(9, "b")] * 200 + [(10, "a")], "k int, g string")
    (light, heavy), (light_ends, heavy_ends) = split_by_weight([df, other], KEYS)
    assert light.columns == df.columns and heavy_ends.columns == other.columns
    assert _rows(light) + _rows(heavy) == Counter(rows)
    assert _rows(light_ends) + _rows(heavy_ends) == _rows(other)
    keys = lambda *frames: Counter(k for f in frames for k in _rows(f, KEYS).elements())
    few, many = keys(light, light_ends), keys(heavy, heavy_ends)
    assert not few.keys() & many.keys() and {(7, "b"), (8, "a"), (9, "b")} <= many.keys()
    assert max(few.values()) * PARTS <= len(rows) + 201


@pytest.mark.parametrize("measures", [("ids",), ("intervals",), ("ids", "intervals")])
def test_eras_are_the_same_by_either_way(spark, measures):
    df = _frame(spark, _records())
    for options in ({}, {"id_col": "id", "measures": measures}, {"id_col": "id", "split": "t", "measures": measures}):
        plain = summarize_eras(df, KEYS, "s", "e", 30, **options)
        weighed = summarize_eras(df, KEYS, "s", "e", 30, weigh=True, **options)
        assert weighed.columns == plain.columns and _rows(weighed) == _rows(plain)


def test_light_eras_by_hand(spark):
    """2,000 keys of two records with three intervals, some of them repeated."""
    rows = [(k, "a", i, "x", DAY0 + timedelta(days=20 * i), DAY0 + timedelta(days=20 * i + n)) for k in range(2000) for i, n in ((0, 5), (0, 9), (1, 4))]
    got = summarize_eras(_frame(spark, rows + rows[:900]), KEYS, "s", "e", 30, id_col="id", weigh=True).collect()
    assert len(got) == 2000
    assert {(r["era_start"], r["era_end"], r["record_count"], r["interval_count"], r["sum_days"]) for r in got} == {
        (DAY0, DAY0 + timedelta(days=24), 2, 3, 18)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_given_ends_are_the_same_by_either_way(spark, how):
    rows = _records(2)
    df = _frame(spark, rows).drop("e")
    ends = era_end_dates(_frame(spark, rows), KEYS, "s", "e").where(F.col("k") % 5 != 0)
    ends = ends.union(ends).union(spark.createDataFrame([(7, "b", None), (None, "a", DAY0)] + [(11, "b", DAY0 + timedelta(days=i % 3)) for i in range(150)], ends.schema))
    got = attach_run_ends(df, ends, KEYS, "s", how=how, weigh=True)
    given = {}
    for k, g, e in ends.collect():
        given.setdefault((k, g), set()).add(e)
    want = Counter()
    for k, g, i, t, s, _ in rows:
        after = [e for e in given.get((k, g), ()) if s and k is not None and g is not None and e and e >= s]
        if after or how == "left":
            want[k, g, i, t, s, min(after, default=None)] += 1
    assert got.columns == [*df.columns, "era_end_date"] and _rows(got) == want
    assert _rows(attach_run_ends(df, ends, KEYS, "s", how=how)) == want


def test_record_counts_are_the_same_by_either_way(spark):
    rows = _records(3)
    record = [*KEYS, "s", "e", "id"]
    df = _frame(spark, rows)
    want = Counter((k, g) for k, g, *_ in {(k, g, s, e, i) for k, g, i, _, s, e in rows})
    for weigh in (False, True):
        got = record_counts(df, KEYS, record, weigh=weigh)
        assert got.columns == [*KEYS, "n"] and {(r["k"], r["g"]): r["n"] for r in got.collect()} == want
        assert got.count() == len(want)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_records_of_light_keys_move_once(spark, tmp_out):
    day = F.date_add(F.lit(DAY0), (F.col("id") % 2 * 9).cast("int"))
    records = spark.range(40_000).select((F.col("id") / 2).cast("int").alias("k"), F.lit("a").alias("g"), "id", day.alias("s"), F.date_add(day, 3).alias("e"))
    records.write.parquet(f"{tmp_out}/records")
    df = spark.read.parquet(f"{tmp_out}/records")
    eras = summarize_eras(df, KEYS, "s", "e", id_col="id", weigh=True)
    plan = _final_plan(eras)
    assert plan.count("Exchange hashpartitioning(k") == 1, plan
    assert _final_plan(summarize_eras(df, KEYS, "s", "e", id_col="id")).count("Exchange hashpartitioning(k") == 3
    eras.select(*KEYS, F.col("era_end").alias("era_end_date")).write.parquet(f"{tmp_out}/ends")
    plan = _final_plan(attach_run_ends(df, spark.read.parquet(f"{tmp_out}/ends"), KEYS, "s", weigh=True))
    assert plan.count("Exchange hashpartitioning(k") == 1 and "SortMergeJoin" not in plan, plan


def test_a_stored_target_gives_the_same_eras(spark, tmp_out):
    srcs = fx.repeated_exposures(spark, SF0001), *fx.drug_sources(spark, SF0001)[1:]
    drug_target(*srcs).write.parquet(f"{tmp_out}/target")
    for gap in ("stockpile", "covered", "both"):
        got = drug_era(*srcs, gap=gap, stored_target=spark.read.parquet(f"{tmp_out}/target"))
        assert _rows(got) == _rows(drug_era(*srcs, gap=gap))


def test_the_target_is_built_once_for_the_stored_queries(spark):
    """What is held against the stored eras is read from the stored target, whose join ran before."""
    for name in ("attach_stored_eras", "stored_drug_era_audit", "stored_drug_era_faults"):
        schemas = [s["ReadSchema"] for s in scan_details(entry._QUERIES[name](spark, SF0001))]
        assert any("drug_exposure_id" in s for s in schemas) and not any("l_orderkey" in s for s in schemas), (name, schemas)
