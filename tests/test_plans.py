"""Plan-shape tests: shuffles, joins, pruning and pushdown stay as designed."""

from __future__ import annotations

from conftest import SF0001
from spanpack import (
    EraConfig,
    assign_era_end,
    attach_run_ends,
    condition_era,
    condition_era_by_type,
    condition_target,
    dose_quality_report,
    drug_era,
    drug_quality_report,
    drug_target,
    era_end_dates,
    pack_intervals,
)
from spanpack.plans.inspect import join_count, operator_counts, scan_details, shuffle_count
from spanpack.sources import fixtures as fx


def test_condition_era_plan(spark):
    df = condition_era(fx.condition_occurrence(spark, SF0001))
    assert join_count(df) == 0
    # (keys, day, id) and (keys, day) aggregate shuffles, each after a partial
    # aggregate, + keys shuffle for the window; the final aggregate reuses the
    # window's partitioning. Where ids are trusted the first one falls away
    assert shuffle_count(df) == 3
    trusted = condition_era(fx.condition_occurrence(spark, SF0001), EraConfig(assume_unique_ids=True))
    assert shuffle_count(trusted) == 2
    ops = operator_counts(df)
    assert ops["Window"] >= 1 and ops["Sort"] == 1
    (scan,) = scan_details(df)
    assert "o_totalprice" not in scan["ReadSchema"]
    assert "IsNotNull(o_custkey)" in scan["PushedFilters"]


def test_type_split_adds_no_shuffle(spark):
    df = condition_era_by_type(fx.condition_occurrence(spark, SF0001))
    assert shuffle_count(df) == 3 and join_count(df) == 0


def test_drug_era_rollup_is_broadcast(spark):
    df = drug_era(*fx.drug_sources(spark, SF0001), gap="both")
    ops = operator_counts(df)
    assert ops["SortMergeJoin"] == 0 and ops["CartesianProduct"] == 0
    assert ops["BroadcastHashJoin"] >= 2
    for scan in scan_details(df):
        assert "l_extendedprice" not in scan["ReadSchema"]


def test_drug_era_rollup_is_a_shuffle_join_where_spark_does_not_broadcast(spark):
    cfg = EraConfig()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = drug_era(*fx.drug_sources(spark, SF0001), cfg=cfg)
        ops = operator_counts(df)
        assert ops["BroadcastHashJoin"] == 0
        assert ops["SortMergeJoin"] + ops["ShuffledHashJoin"] >= 2
        assert df.count() == 6033
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _tree_ops(df):
    import re

    from spanpack.plans.inspect import _tree, plan_text

    ops = []
    for line in _tree(plan_text(df)):
        name = re.sub(r"^[\s:+\-|]*", "", line)
        ops.append(re.sub(r"\s*\(\d+\)\s*$", "", name).strip())
    return ops


def test_window_reads_pre_aggregated_day_rows(spark):
    """Skew guard: every exchange below the window follows a partial aggregate:
    day rows by key, on the (key, day) aggregate, on the (key, day, id) one."""
    for df in (
        condition_era(fx.condition_occurrence(spark, SF0001)),
        condition_era_by_type(fx.condition_occurrence(spark, SF0001)),
        drug_era(*fx.drug_sources(spark, SF0001), gap="stockpile"),
        drug_era(*fx.drug_sources(spark, SF0001), gap="both"),
    ):
        ops = _tree_ops(df)
        w = max(i for i, o in enumerate(ops) if o == "Window")  # the lowest window
        below = [o for o in ops[w + 1:] if o not in ("Project", "Filter")]
        assert below[:8] == [
            "Sort", "Exchange", "HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange", "HashAggregate"
        ], below


def test_row_level_outputs_read_their_source_once(spark):
    """Numbered rows come from the exchange they go back to; the target's join runs once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ct = condition_target(fx.condition_occurrence(spark, SF0001))
        dt = drug_target(*fx.drug_sources(spark, SF0001))
        ends = era_end_dates(ct, ["person_id", "condition_concept_id"], "condition_start_date", "condition_end_date")
        for df, own in (
            (pack_intervals(ct, ["person_id", "condition_concept_id"], "condition_start_date", "condition_end_date"), 1),
            (assign_era_end(dt, ["person_id", "ingredient_concept_id"], "drug_exposure_start_date", "drug_exposure_end_date"), 6),
            # and the ends once more
            (attach_run_ends(ct, ends, ["person_id", "condition_concept_id"], "condition_start_date"), 2),
        ):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert plan.count("FileScan parquet") == own, plan
            assert "ReusedExchange" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unique_ids_aggregate_before_the_shuffle(spark):
    df = condition_era(fx.condition_occurrence(spark, SF0001), EraConfig(assume_unique_ids=True))
    ops = _tree_ops(df)
    below = [o for o in ops[max(i for i, o in enumerate(ops) if o == "Window") + 1:] if o not in ("Project", "Filter")]
    assert below[:5] == ["Sort", "Exchange", "HashAggregate", "Exchange", "HashAggregate"], below


def test_building_a_dataframe_starts_no_job(spark):
    sources = fx.drug_sources(spark, SF0001)
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        drug_era(*sources, gap="both")
        dose_quality_report(*sources)
        drug_quality_report(*sources)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unmapped_filter_reaches_the_scan(spark):
    cfg = EraConfig(exclude_unmapped=True, unmapped_id="4-NOT SPECIFIED")
    (scan,) = scan_details(condition_era(fx.condition_occurrence(spark, SF0001), cfg))
    assert "Not(EqualTo(o_orderpriority,4-NOT SPECIFIED))" in scan["PushedFilters"]
