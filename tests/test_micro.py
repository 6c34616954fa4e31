"""Hand-checked micro fixtures (FIXTURES.md section 2).

Numbers are day offsets from 2020-01-01; grace 30 unless stated.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanpack import (
    EraConfig,
    condition_era,
    condition_era_by_type,
    dose_era,
    drug_era,
    drug_era_by_type,
    drug_target,
    merge_overlaps,
    normalize_condition_end,
    normalize_drug_end,
    quarantine,
    sub_exposure_days,
)
from spanpack.schemas import CONCEPT, CONCEPT_ANCESTOR, CONDITION_OCCURRENCE, DRUG_EXPOSURE

BASE = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else BASE + dt.timedelta(days=n)


def off(d):
    return (d - BASE).days


# drug 100 -> ingredient 1; drug 500 -> ingredients 10, 11 and brand 90;
# drug 600 -> brand 90 only
ANCESTORS = [(1, 100), (10, 500), (11, 500), (90, 500), (90, 600)]
CONCEPTS = [(1, 8, "Ingredient"), (10, 8, "Ingredient"), (11, 8, "Ingredient"), (90, 8, "Brand Name")]


def vocab(spark):
    return (
        spark.createDataFrame(ANCESTORS, CONCEPT_ANCESTOR),
        spark.createDataFrame(CONCEPTS, CONCEPT),
    )


def drugs(spark, rows):
    """rows: (person, drug, start, end, supply[, type, unit, dose])"""
    out = []
    for i, r in enumerate(rows):
        person, drug, s, e, supply, *rest = r
        typ, unit, dose = (rest + [None, None, None])[:3] if rest else (None, None, None)
        out.append((i + 1, person, drug, typ, day(s), day(e), supply, unit,
                    None if dose is None else Decimal(dose)))
    return spark.createDataFrame(out, DRUG_EXPOSURE)


def conditions(spark, rows):
    """rows: (person, concept, start, end[, type])"""
    out = []
    for i, r in enumerate(rows):
        person, concept, s, e, *rest = r
        out.append((i + 1, person, concept, rest[0] if rest else None, day(s), day(e)))
    return spark.createDataFrame(out, CONDITION_OCCURRENCE)


def drug_rows(spark, intervals, gap):
    de = drugs(spark, [(1, 100, s, e, None) for s, e in intervals])
    out = drug_era(de, *vocab(spark), gap=gap).collect()
    return sorted(
        (off(r.drug_era_start_date), off(r.drug_era_end_date), r.drug_exposure_count, r.gap_days)
        for r in out
    )


# ------------------------------------------------------------- T1 / T2
@pytest.mark.parametrize(
    "end,supply,expected",
    [(5, 30, 5), (None, 7, 7), (None, 0, 1), (None, None, 1), (0, 9, 0), (None, -3, -3), (-2, 9, -2)],
)
def test_drug_end_normalisation(spark, end, supply, expected):
    de = drugs(spark, [(1, 100, 0, end, supply)])
    got = normalize_drug_end(de).collect()[0].drug_exposure_end_date
    assert off(got) == expected


def test_drug_end_source_branches(spark):
    de = drugs(spark, [(1, 100, 0, 5, 30), (1, 100, 0, None, 7), (1, 100, 0, None, 0), (1, 100, 0, None, None)])
    got = [r.src for r in normalize_drug_end(de, source_col="src").orderBy("drug_exposure_id").collect()]
    assert got == ["given", "supply", "default", "default"]


def test_invalid_drug_intervals_are_quarantined(spark):
    de = drugs(spark, [(1, 100, 0, None, -3), (1, 100, 0, -2, 9), (1, 100, 0, 5, None)])
    t = drug_target(de, *vocab(spark))
    assert t.count() == 1
    bad = quarantine(normalize_drug_end(de), ["person_id"], "drug_exposure_start_date", "drug_exposure_end_date")
    assert sorted(r.reason for r in bad.collect()) == ["end_before_start", "end_before_start"]


def test_condition_end_normalisation(spark):
    co = conditions(spark, [(1, 7, 0, None), (1, 7, 3, 9)])
    got = sorted(off(r.condition_end_date) for r in normalize_condition_end(co).collect())
    assert got == [1, 9]


# ------------------------------------------------------------- packing and gaps
CASES = {
    "gap exactly 30": ([(0, 10), (40, 50)], [(0, 50, 2, 30)], [(0, 50, 2, 30)]),
    "gap 31": ([(0, 10), (41, 50)], [(0, 10, 1, 0), (41, 50, 1, 0)], [(0, 10, 1, 0), (41, 50, 1, 0)]),
    "overlap": ([(0, 30), (10, 40)], [(0, 40, 2, -20)], [(0, 40, 2, 0)]),
    "contained": ([(0, 100), (10, 20), (125, 130)], [(0, 130, 3, 15)], [(0, 130, 3, 25)]),
    "touching": ([(0, 10), (10, 20)], [(0, 20, 2, 0)], [(0, 20, 2, 0)]),
    "zero length": ([(5, 5)], [(5, 5, 1, 0)], [(5, 5, 1, 0)]),
    "overlap + hole": ([(0, 30), (10, 40), (60, 70)], [(0, 70, 3, 0)], [(0, 70, 3, 20)]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_packing_and_gap_days(spark, name):
    intervals, stockpile, covered = CASES[name]
    assert drug_rows(spark, intervals, "stockpile") == stockpile
    assert drug_rows(spark, intervals, "covered") == covered


def test_sub_exposures_of_overlap_plus_hole(spark):
    de = drugs(spark, [(1, 100, s, e, None) for s, e in [(0, 30), (10, 40), (60, 70)]])
    t = drug_target(de, *vocab(spark))
    subs = sub_exposure_days(t, ["person_id", "ingredient_concept_id"], "drug_exposure_start_date", "drug_exposure_end_date")
    got = sorted((off(r.sub_start), off(r.sub_end), r.record_count, r.days_exposed) for r in subs.collect())
    assert got == [(0, 40, 2, 40), (60, 70, 1, 10)]
    assert merge_overlaps(t, ["person_id", "ingredient_concept_id"], "drug_exposure_start_date", "drug_exposure_end_date").count() == 2


def test_grace_parameter(spark):
    co = conditions(spark, [(1, 7, 0, 10), (1, 7, 13, 14)])
    assert condition_era(co, EraConfig(grace_days=2)).count() == 2
    assert condition_era(co, EraConfig(grace_days=3)).count() == 1


# ------------------------------------------------------------- type split
def test_condition_type_split(spark):
    co = conditions(spark, [(1, 7, 0, 10, 1), (1, 7, 20, 40, 2), (1, 7, 45, 50, 1)])
    got = sorted(
        (r.condition_type_concept_id, off(r.condition_era_start_date), off(r.condition_era_end_date), r.condition_occurrence_count)
        for r in condition_era_by_type(co).collect()
    )
    assert got == [(1, 0, 50, 2), (2, 20, 50, 1)]
    unsplit = [(off(r.condition_era_start_date), off(r.condition_era_end_date), r.condition_occurrence_count)
               for r in condition_era(co).collect()]
    assert unsplit == [(0, 50, 3)]


def test_drug_type_split_and_gaps(spark):
    rows = [(1, 100, 0, 10, None, 1), (1, 100, 20, 40, None, 2), (1, 100, 45, 50, None, 1)]
    de = drugs(spark, rows)
    got = sorted(
        (r.drug_type_concept_id, off(r.drug_era_start_date), off(r.drug_era_end_date), r.drug_exposure_count)
        for r in drug_era_by_type(de, *vocab(spark)).collect()
    )
    assert got == [(1, 0, 50, 2), (2, 20, 50, 1)]
    both = drug_era(de, *vocab(spark), gap="both").collect()
    assert [(r.drug_exposure_count, r.gap_days_stockpile, r.gap_days_covered) for r in both] == [(3, 15, 15)]


def test_null_type_is_its_own_group(spark):
    co = conditions(spark, [(1, 7, 0, 10, None)])
    r = condition_era_by_type(co).collect()
    assert [(x.condition_type_concept_id, off(x.condition_era_start_date), off(x.condition_era_end_date), x.condition_occurrence_count) for x in r] == [(None, 0, 10, 1)]


# ------------------------------------------------------------- dose, ingredients
def test_dose_eras(spark):
    rows = [
        (1, 100, 0, 10, None, None, 5, "5"),
        (1, 100, 5, 15, None, None, 5, "10"),
        (1, 100, 30, 35, None, None, 5, "5"),
        (1, 100, 0, 9, None, None, 5, None),
    ]
    out = dose_era(drugs(spark, rows), *vocab(spark)).collect()
    got = sorted((int(r.dose_value), off(r.dose_era_start_date), off(r.dose_era_end_date)) for r in out)
    assert got == [(5, 0, 35), (10, 5, 15)]


def test_combination_drug_fans_out_and_brands_are_ignored(spark):
    de = drugs(spark, [(1, 500, 0, 10, None), (1, 600, 0, 10, None)])
    got = sorted((r.drug_concept_id, r.drug_exposure_count) for r in drug_era(de, *vocab(spark)).collect())
    assert got == [(10, 1), (11, 1)]


def test_duplicate_ancestor_rows_do_not_double_count(spark):
    de = drugs(spark, [(1, 100, 0, 10, None)])
    ca = spark.createDataFrame(ANCESTORS + [(1, 100)], CONCEPT_ANCESTOR)
    c = spark.createDataFrame(CONCEPTS, CONCEPT)
    assert [r.drug_exposure_count for r in drug_era(de, ca, c).collect()] == [1]


def test_shuffle_join_path_gives_same_eras(spark):
    de = drugs(spark, [(1, 500, 0, 10, None), (1, 100, 5, 9, None), (2, 100, 0, 3, 4)])
    a = sorted(map(tuple, drug_era(de, *vocab(spark)).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(map(tuple, drug_era(de, *vocab(spark)).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b and len(a) == 4


def _gaps(rows):
    return [(r.drug_exposure_count, r.drug_exposure_count_stockpile, r.gap_days_stockpile, r.gap_days_covered) for r in rows]


def test_a_repeated_id_counts_once(spark):
    """The same id and start: an identical row, another supply with the same
    end, and another end (an interval of its own for stockpile eras only)."""
    def eras(rows, **cfg):
        de = drugs(spark, rows).withColumn("drug_exposure_id", F.lit(7).cast("long"))
        return drug_era(de, *vocab(spark), EraConfig(**cfg), gap="both").collect()

    assert _gaps(eras([(1, 100, 0, 10, None), (1, 100, 0, 10, None)])) == [(1, 1, 0, 0)]
    assert _gaps(eras([(1, 100, 0, 10, 10), (1, 100, 0, 10, 11)])) == [(1, 1, 0, 0)]
    assert _gaps(eras([(1, 100, 0, 10, None), (1, 100, 0, 20, None)])) == [(1, 2, -10, 0)]
    assert _gaps(eras([(1, 100, 0, 10, None), (1, 100, 5, 9, None)])) == [(2, 2, -4, 0)]
    assert _gaps(eras([(1, 100, 0, 10, None), (1, 100, 0, 10, None)], assume_unique_ids=True)) == [(2, 2, -10, 0)]


# ------------------------------------------------------------- NULLs and invalid rows
def test_null_person_or_concept_gives_no_era(spark):
    schema = T.StructType([f if f.name not in ("person_id",) else T.StructField("person_id", T.LongType(), True)
                           for f in CONDITION_OCCURRENCE])
    co = spark.createDataFrame(
        [(1, None, 7, None, day(0), day(5)), (2, 1, None, None, day(0), day(5)), (3, 1, 7, None, day(0), day(5))],
        schema,
    )
    got = [(r.person_id, r.condition_concept_id) for r in condition_era(co).collect()]
    assert got == [(1, 7)]


def test_null_start_is_quarantined(spark):
    co = conditions(spark, [(1, 7, 0, 10), (1, 7, None, 5)])
    got = [(off(r.condition_era_start_date), off(r.condition_era_end_date), r.condition_occurrence_count)
           for r in condition_era(co).collect()]
    assert got == [(0, 10, 1)]


def test_end_before_start_quarantine_and_clamp(spark):
    co = conditions(spark, [(1, 7, 100, 90), (1, 7, 200, 210)])
    got = sorted((off(r.condition_era_start_date), off(r.condition_era_end_date), r.condition_occurrence_count)
                 for r in condition_era(co).collect())
    assert got == [(200, 210, 1)]
    clamped = sorted((off(r.condition_era_start_date), off(r.condition_era_end_date), r.condition_occurrence_count)
                     for r in condition_era(co, EraConfig(invalid="clamp")).collect())
    assert clamped == [(100, 100, 1), (200, 210, 1)]


def test_optional_filters(spark):
    de = drugs(spark, [(1, 100, 0, None, -3), (1, 100, 50, 60, None), (1, 100, 100, None, 5)])
    t5 = drug_target(de, *vocab(spark), cfg=EraConfig(require_nonneg_supply=True))
    assert t5.count() == 1          # negative and NULL supply both dropped (three-valued logic)
    t5n = drug_target(de, *vocab(spark), cfg=EraConfig(require_nonneg_supply=True, nonneg_supply_keeps_null=True))
    assert t5n.count() == 2
    co = conditions(spark, [(1, 0, 0, 5), (1, 7, 0, 5)])
    assert condition_era(co, EraConfig(exclude_unmapped=True)).count() == 1


def test_unmapped_id_of_another_type_never_raises(spark):
    from spanpack import condition_quality_report

    co = conditions(spark, [(1, 7, 0, 5), (1, 0, 0, 5)]).withColumn(
        "condition_concept_id", F.concat(F.lit("c"), F.col("condition_concept_id").cast("string"))
    )
    assert condition_era(co, EraConfig(exclude_unmapped=True)).count() == 2      # 0 matches no text id
    assert condition_era(co, EraConfig(exclude_unmapped=True, unmapped_id="c0")).count() == 1
    rep = {r.reason: r.row_count for r in condition_quality_report(co).collect()}
    assert rep["unmapped_concept"] == 0


@pytest.mark.parametrize("supply_type", ["bigint", "double", "int"])
def test_days_supply_of_any_numeric_type(spark, supply_type):
    supply = 5.0 if supply_type == "double" else 5
    df = spark.createDataFrame(
        [(day(0), None, supply)], f"drug_exposure_start_date date, drug_exposure_end_date date, days_supply {supply_type}"
    )
    assert off(normalize_drug_end(df).first().drug_exposure_end_date) == 5
