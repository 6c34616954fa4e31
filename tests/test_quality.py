"""Q1 count reconciliation and Q2 quality reports."""

from __future__ import annotations

from conftest import SF0001
from spanpack import (
    EraConfig,
    condition_quality_report,
    drug_era,
    drug_quality_report,
    drug_target,
    reconcile_counts,
    quarantine,
    split_valid,
)
from spanpack.sources import fixtures as fx
from test_micro import conditions, drugs, vocab


def test_reconcile_counts_match_on_fixture(spark):
    srcs = fx.drug_sources(spark, SF0001)
    r = reconcile_counts(drug_target(*srcs), drug_era(*srcs), "drug_exposure_count").first()
    assert (r.target_rows, r.era_count_sum, r.matches) == (7122, 7122, True)


def test_reconcile_detects_a_mismatched_filter(spark):
    de = drugs(spark, [(1, 100, 0, 5, 5), (1, 100, 50, 60, -1)])
    srcs = (de, *vocab(spark))
    strict = drug_target(*srcs, cfg=EraConfig(require_nonneg_supply=True))
    r = reconcile_counts(strict, drug_era(*srcs), "drug_exposure_count").first()
    assert (r.target_rows, r.era_count_sum, r.matches) == (1, 2, False)


def test_drug_quality_report(spark):
    de = drugs(spark, [
        (1, 100, 0, None, -3),      # negative supply -> end before start
        (1, 0, 0, 5, None),         # unmapped (and no ingredient) + NULL supply with an end
        (1, 600, 0, 5, 4),          # brand only: no ingredient
        (1, 100, 0, 5, 4),          # fine
    ])
    rep = {r.reason: r.row_count for r in drug_quality_report(de, *vocab(spark)).collect()}
    assert rep["negative_days_supply"] == 1 and rep["end_before_start"] == 1
    assert rep["unmapped_concept"] == 1 and rep["no_ingredient"] == 2
    assert rep["null_supply_with_end_date"] == 1 and rep["null_person_id"] == 0


def test_condition_quality_report_and_split(spark):
    co = conditions(spark, [(1, 0, 0, 5), (1, 7, 10, 5), (1, 7, None, 5), (1, 7, 0, None)])
    rep = {r.reason: r.row_count for r in condition_quality_report(co, EraConfig()).collect()}
    assert rep == {"null_person_id": 0, "null_start_date": 1, "null_concept_id": 0,
                   "unmapped_concept": 1, "end_before_start": 1}
    valid, bad = split_valid(co, ["person_id", "condition_concept_id"], "condition_start_date", "condition_end_date")
    assert valid.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["end_before_start", "null_end_date", "null_start_date"]


def test_quarantine_reason_precedence(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.DateType()), T.StructField("e", T.DateType())])
    import datetime as dt

    d = dt.date(2020, 1, 10)
    early = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(None, d, early), (1, d, early), (1, None, early), (None, d, d)], schema)
    got = sorted(((r.k, r.reason) for r in quarantine(df, ["k"], "s", "e").collect()), key=repr)
    expected = [(None, "null_k"), (1, "end_before_start"), (1, "null_start_date"), (None, "null_k")]
    assert got == sorted(expected, key=repr)


def test_dose_quality_report_counts_dropped_target_rows(spark):
    from spanpack import dose_quality_report
    from conftest import SF001

    rep = {r.reason: r.row_count for r in dose_quality_report(*fx.drug_sources(spark, SF001)).collect()}
    # FIXTURES.md: 71,902 target rows, 3,497 with a NULL dose, 68,405 in dose eras
    assert rep["target_rows"] == 71902 and rep["null_dose_value"] == 3497
    assert rep["target_rows"] - rep["dropped_null_unit_or_dose"] == 68405
