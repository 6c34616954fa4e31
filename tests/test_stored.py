"""Stored era tables (commits, audits), the split sink, given run ends, dirty sources."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from spanpack import EraConfig, attach_run_ends, condition_era, condition_era_by_type, drug_era, drug_era_by_type
from spanpack.operators.packing import assign_era_end, era_end_dates, pack_intervals
from spanpack.operators.quality import audit_buckets, audit_summary, bucket_sums, differing_keys, reconcile_counts, record_counts, stored_counts
from spanpack.operators.targets import condition_target
from spanpack.plans import ERA_OUTPUTS, build_era_tables, publish_era_tables
from spanpack.plans.inspect import scan_details
from spanpack.sources import fixtures as fx, publish_split, publish_version, ranged, read_era_table, read_split, read_version

KEYS = ["person_id", "condition_concept_id"]
RECORD = [*KEYS, "condition_start_date", "condition_occurrence_id"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def failing(spark):
    boom = F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id").cast("string"))
    return spark.range(0, 10, 1, 4).select("id", boom.alias("x"))


# ----------------------------------------------------------------- commits
def test_a_failed_overwrite_of_a_path_leaves_the_old_eras(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    old = spark.range(5).select("id", F.lit("old").alias("x"))
    publish_version(old, path, sort_within=["id"])
    with pytest.raises(Exception, match="boom"):
        publish_version(failing(spark), path, sort_within=["id"])
    assert rows(read_version(spark, path)) == rows(old)
    with pytest.raises(Exception, match="boom"):
        publish_version(failing(spark), path, mode="append", sort_within=["id"])
    assert rows(read_version(spark, path)) == rows(old)
    publish_version(spark.range(2).select("id", F.lit("new").alias("x")), path, sort_within=["id"])
    assert rows(read_version(spark, path)) == [(0, "new"), (1, "new")]


def test_a_failed_overwrite_of_job_outputs_by_path(spark, tmp_out):
    paths = {"drug_era": os.path.join(tmp_out, "drug_era")}
    good = spark.range(3).withColumn("person_id", F.col("id"))
    publish_era_tables({"drug_era": good}, paths=paths)
    with pytest.raises(Exception, match="boom"):
        publish_era_tables({"drug_era": failing(spark).withColumn("person_id", F.col("id"))}, paths=paths)
    assert rows(read_era_table(spark, "drug_era", path=paths["drug_era"])) == rows(good)


def test_a_batch_is_appended_once(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    a, b = spark.range(3), spark.range(3, 5)
    assert publish_version(a, path, "append", "a", sort_within=None) and publish_version(b, path, "append", "b", sort_within=None)
    assert publish_version(a, path, "append", "a", sort_within=None) is None
    assert rows(read_version(spark, path)) == [(i,) for i in range(5)]
    publish_version(a, path, "append", sort_within=None)                 # without a name it counts again
    assert read_version(spark, path).count() == 8
    publish_version(b, path, sort_within=None)                           # an overwrite starts anew
    assert publish_version(a, path, "append", "a", sort_within=None)
    assert read_version(spark, path).count() == 5


def test_nothing_published(spark, tmp_out):
    with pytest.raises(FileNotFoundError):
        read_version(spark, os.path.join(tmp_out, "none"))
    with pytest.raises(ValueError):
        publish_version(spark.range(1), tmp_out, mode="merge")


def test_ranged_layout_cuts_a_hot_person(spark, tmp_out):
    hot = F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id") % 500)
    df = spark.range(0, 60_000, 1, 8).select(hot.alias("person_id"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 5000).cast("int")).alias("s"))
    ranged(df, ["person_id", "s"], 8).write.parquet(f"{tmp_out}/t")
    counts = []
    for name in sorted(glob.glob(f"{tmp_out}/t/*.parquet")):
        import pyarrow.parquet as pq

        t = pq.read_table(name)
        pairs = list(zip(t["person_id"].to_pylist(), t["s"].to_pylist()))
        assert pairs == sorted(pairs)
        counts.append(len(pairs))
    assert len(counts) == 8 and sum(counts) == 60_000 and max(counts) <= 2 * min(counts), counts


# ------------------------------------------------------------------ audits
def _condition_sides(spark, drop=None):
    co = fx.repeated_conditions(spark, SF0001)
    eras = condition_era(co)
    if drop is not None:
        eras = eras.where(~drop)
    return record_counts(condition_target(co), KEYS, RECORD), stored_counts(eras, KEYS, "condition_occurrence_count")


def test_audit_agrees_where_ids_repeat(spark):
    co = fx.repeated_conditions(spark, SF0001)
    r = reconcile_counts(condition_target(co), condition_era(co), "condition_occurrence_count", RECORD).first()
    assert r["matches"] and r["target_rows"] < condition_target(co).count()
    assert audit_summary(*_condition_sides(spark), KEYS).first()["matches"]


def test_a_lost_row_is_located(spark):
    expected, stored = _condition_sides(spark)
    lost = expected.orderBy(*KEYS).first()
    gone = (F.col("person_id") == lost["person_id"]) & (F.col("condition_concept_id") == lost["condition_concept_id"])
    expected, stored = _condition_sides(spark, gone)
    assert not audit_summary(expected, stored, KEYS).first()["matches"]
    assert audit_buckets(expected, stored, KEYS).where(~F.col("matches")).count() == 1
    assert rows(differing_keys(expected, stored, KEYS)) == [(lost["person_id"], lost["condition_concept_id"], lost["n"], 0)]
    assert rows(differing_keys(stored, expected, KEYS)) == [(lost["person_id"], lost["condition_concept_id"], 0, lost["n"])]


def test_counts_that_cancel_out_are_found(spark):
    """One too many and one too few in one bucket sum to the same records."""
    a = spark.createDataFrame([(1, "x", 5), (2, "x", 5)], "person_id long, condition_concept_id string, n long")
    b = spark.createDataFrame([(1, "x", 6), (2, "x", 4)], a.schema)
    assert rows(differing_keys(a, b, KEYS, buckets=1)) == [(1, "x", 5, 6), (2, "x", 5, 4)]


def test_bucket_sums_merge(spark):
    counts, _ = _condition_sides(spark)
    even, odd = (bucket_sums(counts.where(F.col("person_id") % 2 == i), KEYS, 16) for i in (0, 1))
    merged = even.union(odd).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n_keys", "records", "digest")])
    assert rows(merged) == rows(bucket_sums(counts, KEYS, 16))


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "person_id long, condition_concept_id string, n long")
    r = audit_summary(none, none, KEYS).first()
    assert r["matches"] and r["expected_records"] == 0 and differing_keys(none, none, KEYS).count() == 0


# --------------------------------------------------------- given run ends
def test_given_ends_equal_computed_ones(spark):
    t = condition_target(fx.condition_occurrence(spark, SF0001))
    ends = era_end_dates(t, KEYS, "condition_start_date", "condition_end_date")
    doubled = ends.union(ends).union(ends.withColumn("era_end_date", F.lit(None).cast("date")))
    got = attach_run_ends(t, doubled, KEYS, "condition_start_date")
    assert rows(got) == rows(assign_era_end(t, KEYS, "condition_start_date", "condition_end_date"))


def test_given_ends_edges(spark):
    recs = spark.createDataFrame(
        [(1, "2020-01-05"), (1, "2020-01-10"), (1, "2020-01-11"), (1, "2020-03-01"), (2, "2020-01-01"), (None, "2020-01-01"), (1, None), (1, "2020-01-05")],
        "k long, s string").select("k", F.to_date("s").alias("s"))
    ends = spark.createDataFrame([(1, "2020-01-10"), (1, "2020-02-01"), (3, "2020-05-05"), (None, "2020-05-05")], "k long, e string").select("k", F.to_date("e").alias("e"))
    show = lambda df: sorted((r["k"], str(r["s"]), str(r["e"])) for r in df.collect() if r["k"] is not None)
    inner = [(1, "2020-01-05", "2020-01-10"), (1, "2020-01-05", "2020-01-10"), (1, "2020-01-10", "2020-01-10"), (1, "2020-01-11", "2020-02-01")]
    assert show(attach_run_ends(recs, ends, "k", "s", "e")) == inner
    left = attach_run_ends(recs, ends, "k", "s", "e", how="left")
    assert left.count() == 8
    assert show(left) == sorted(inner + [(1, "2020-03-01", "None"), (1, "None", "None"), (2, "2020-01-01", "None")])


def test_row_level_outputs_keep_every_record(spark):
    """Records that are alike in all columns, and columns that cannot be hashed."""
    t = condition_target(fx.condition_occurrence(spark, SF0001))
    t = t.union(t).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    out = pack_intervals(t, KEYS, "condition_start_date", "condition_end_date")
    assert out.count() == 3000 and out.columns == [*t.columns, "era_seq"]


# -------------------------------------------------------------- split sink
def test_split_sink_writes_each_row_once(spark, tmp_out):
    rows_ = fx.dirty_conditions(spark, SF0001)
    publish_split(rows_, KEYS, "condition_start_date", "condition_end_date", f"{tmp_out}/t")
    clean, bad = read_split(spark, f"{tmp_out}/t")
    assert clean.count() + bad.count() == rows_.count() and clean.columns == rows_.columns
    reasons = {r["reason"]: r["count"] for r in bad.groupBy("reason").count().collect()}
    assert set(reasons) == {"null_start_date", "null_end_date", "null_person_id", "null_condition_concept_id", "end_before_start"}
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "reason" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_dirty_sources_reach_every_reason(spark):
    from spanpack import condition_quality_report, dose_quality_report, drug_quality_report

    drug = (fx.dirty_exposures(spark, SF0001), *fx.drug_sources(spark, SF0001)[1:])
    for report in (drug_quality_report(*drug), condition_quality_report(fx.dirty_conditions(spark, SF0001)), dose_quality_report(*drug)):
        counts = {r["reason"]: r["row_count"] for r in report.collect()}
        assert all(counts.values()), counts


# --------------------------------------------------------- both grains at once
def test_whole_job_by_id_reads_one_numbering(spark):
    co, de = fx.repeated_conditions(spark, SF0001), fx.repeated_exposures(spark, SF0001)
    _, ca, c = fx.drug_sources(spark, SF0001)
    srcs = {"condition_occurrence": co, "drug_exposure": de, "concept_ancestor": ca, "concept": c}
    for gap in ("stockpile", "covered", "both"):
        eras = build_era_tables(srcs, outputs=list(ERA_OUTPUTS), gap=gap)
        assert rows(eras["drug_era"]) == rows(drug_era(de, ca, c, gap=gap))
    assert rows(eras["condition_era"]) == rows(condition_era(co))
    assert rows(eras["condition_era_by_type"]) == rows(condition_era_by_type(co))
    assert rows(eras["drug_era_by_type"]) == rows(drug_era_by_type(de, ca, c))
    for name in ("condition_era", "condition_era_by_type", "drug_era", "drug_era_by_type"):
        assert all("orders.parquet" not in s["Location"] for s in scan_details(eras[name]))
    never = build_era_tables(srcs, EraConfig(), outputs=["condition_era", "condition_era_by_type"], materialize="never")
    assert rows(never["condition_era_by_type"]) == rows(eras["condition_era_by_type"])
