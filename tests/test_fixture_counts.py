"""Absolute numbers of FIXTURES.md section 3.4 at sf0.001 and sf0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001, TESTDATA

SF01 = f"{TESTDATA}/sf0.1"
from spanpack import (
    EraConfig,
    condition_era,
    condition_era_by_type,
    dose_era,
    dose_target,
    drug_era,
    drug_era_by_type,
    drug_target,
    filter_nonneg_supply,
    merge_overlaps,
    normalize_drug_end,
)
from spanpack.sources import fixtures as fx

EXPECTED = {
    SF0001: dict(cond=1446, cond_multi=52, cond_type=1479, target=7122, branches=(1047, 3999, 2076),
                 subs=6738, drug=6033, drug_multi=889, g1=7846, neg=272, g2=10519, drug_type=6700,
                 null_dose=344, dose=6516, dose_src=6778, t4_rows=1203, t4_eras=1160, t5=4032, t5_null=276),
    SF001: dict(cond=14404, cond_multi=575, cond_type=14807, target=71902, branches=(10294, 40161, 21447),
                subs=68261, drug=61022, drug_multi=8871, g1=85245, neg=2500, g2=108701, drug_type=67803,
                null_dose=3497, dose=65836, dose_src=68405, t4_rows=11980, t4_eras=11500, t5=39954, t5_null=2849),
    SF01: dict(cond=143838, cond_multi=5901, cond_type=147865, target=719043, branches=(102806, 402295, 213942),
               subs=681972, drug=610422, drug_multi=89082, g1=839730, neg=25810, g2=1082418, drug_type=678035,
               null_dose=36408, dose=656552, dose_src=682635, t4_rows=120080, t4_eras=115133, t5=399975,
               t5_null=28470),
}
KEYS = ["person_id", "ingredient_concept_id"]


@pytest.mark.parametrize("sf", [SF0001, SF001, SF01])
def test_condition_counts(spark, sf):
    x = EXPECTED[sf]
    co = fx.condition_occurrence(spark, sf)
    r = condition_era(co).agg(
        F.count("*").alias("n"), F.sum("condition_occurrence_count").alias("s"),
        F.sum((F.col("condition_occurrence_count") > 1).cast("int")).alias("multi"),
    ).first()
    assert (r.n, r.s, r.multi) == (x["cond"], co.count(), x["cond_multi"])
    assert condition_era_by_type(co).count() == x["cond_type"]
    cfg = EraConfig(exclude_unmapped=True, unmapped_id="4-NOT SPECIFIED")
    assert co.filter(F.col("condition_concept_id") != "4-NOT SPECIFIED").count() == x["t4_rows"]
    assert condition_era(co, cfg).count() == x["t4_eras"]


@pytest.mark.parametrize("sf", [SF0001, SF001, SF01])
def test_drug_counts(spark, sf):
    x = EXPECTED[sf]
    srcs = fx.drug_sources(spark, sf)
    de, ca, c = srcs
    t = drug_target(*srcs)
    assert t.count() == x["target"]
    src = normalize_drug_end(de, source_col="src").join(
        t.select(F.col("drug_exposure_id").alias("drug_exposure_id"), "ingredient_concept_id"), "drug_exposure_id"
    )
    b = {r.src: r["count"] for r in src.groupBy("src").count().collect()}
    assert (b["given"], b["supply"], b["default"]) == x["branches"]
    assert merge_overlaps(t, KEYS, "drug_exposure_start_date", "drug_exposure_end_date").count() == x["subs"]
    r = drug_era(*srcs, gap="both").agg(
        F.count("*").alias("n"), F.sum("drug_exposure_count").alias("s"),
        F.sum((F.col("drug_exposure_count") > 1).cast("int")).alias("multi"),
        F.sum("gap_days_stockpile").alias("g1"), F.sum((F.col("gap_days_stockpile") < 0).cast("int")).alias("neg"),
        F.sum("gap_days_covered").alias("g2"), F.min("gap_days_covered").alias("g2min"),
    ).first()
    assert (r.n, r.s, r.multi, r.g1, r.neg, r.g2) == (
        x["drug"], x["target"], x["drug_multi"], x["g1"], x["neg"], x["g2"])
    assert r.g2min >= 0
    assert drug_era_by_type(*srcs).count() == x["drug_type"]
    dt = dose_target(*srcs)
    assert dt.filter(F.col("dose_value").isNull()).count() == x["null_dose"]
    assert dose_era(*srcs).count() == x["dose"]
    assert dt.filter(F.col("dose_value").isNotNull() & F.col("unit_concept_id").isNotNull()).count() == x["dose_src"]
    assert filter_nonneg_supply(de).count() == x["t5"]
    assert de.filter(F.col("days_supply").isNull() & F.col("drug_exposure_end_date").isNotNull()).count() == x["t5_null"]
