"""DataFrame operators: targets (T1-T5), packing (P1-P5), eras (E1-E6), quality (Q1, Q2)."""

from spanpack.operators.eras import (
    condition_era,
    condition_era_by_type,
    condition_eras_by_type_from_target,
    condition_eras_from_target,
    dose_era,
    dose_eras_from_target,
    drug_era,
    drug_era_by_type,
    drug_eras_by_type_from_target,
    drug_eras_from_target,
)
from spanpack.operators.packing import (
    assign_era_end,
    attach_run_ends,
    collapse_eras,
    numbered_day_rows,
    era_end_dates,
    merge_overlaps,
    pack_intervals,
    sub_exposure_days,
    summarize_eras,
)
from spanpack.operators.quality import (
    audit_buckets,
    audit_summary,
    differing_keys,
    record_counts,
    stored_counts,
    condition_quality_report,
    dose_quality_report,
    drug_quality_report,
    duplicate_id_report,
    quality_report,
    quarantine,
    reconcile_counts,
    split_valid,
)
from spanpack.operators.spread import heavy_keys, split_by_weight, spread_join
from spanpack.operators.targets import (
    condition_target,
    dose_target,
    drug_target,
    filter_nonneg_supply,
    filter_unmapped,
    ingredient_map,
    normalize_condition_end,
    normalize_drug_end,
    rollup_to_ingredient,
)

__all__ = [
    "attach_run_ends",
    "audit_buckets",
    "audit_summary",
    "differing_keys",
    "record_counts",
    "stored_counts",
    "assign_era_end",
    "collapse_eras",
    "numbered_day_rows",
    "condition_era",
    "condition_era_by_type",
    "condition_eras_by_type_from_target",
    "condition_eras_from_target",
    "dose_eras_from_target",
    "drug_eras_by_type_from_target",
    "drug_eras_from_target",
    "duplicate_id_report",
    "condition_quality_report",
    "condition_target",
    "dose_era",
    "dose_quality_report",
    "dose_target",
    "drug_era",
    "drug_era_by_type",
    "drug_quality_report",
    "drug_target",
    "era_end_dates",
    "filter_nonneg_supply",
    "filter_unmapped",
    "ingredient_map",
    "merge_overlaps",
    "normalize_condition_end",
    "normalize_drug_end",
    "pack_intervals",
    "quality_report",
    "quarantine",
    "reconcile_counts",
    "rollup_to_ingredient",
    "split_valid",
    "sub_exposure_days",
    "summarize_eras",
]
