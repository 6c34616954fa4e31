"""End-user era builders (E1-E6).

Each is target builder -> :func:`summarize_eras` -> a projection to the era
table's columns. ``drug_concept_id`` in every drug output holds the
*ingredient* id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanpack.config import EraConfig
from spanpack.functions.dates import gap_days_covered, gap_days_stockpile
from spanpack.operators.packing import summarize_eras
from spanpack.operators.targets import (
    COND_END,
    COND_START,
    CONDITION_KEYS,
    DOSE_KEYS,
    DRUG_END,
    DRUG_KEYS,
    DRUG_START,
    condition_target,
    dose_target,
    drug_target,
)

GAP_METHODS = ("stockpile", "covered", "both")


def gap_measures(gap: str) -> tuple[str, ...]:
    """What :func:`drug_era_columns` reads from the eras: stockpile eras count
    intervals, covered eras ids."""
    return {"stockpile": ("intervals",), "covered": ("ids",)}.get(gap, ("ids", "intervals"))


def condition_eras_from_target(target: DataFrame, cfg: EraConfig = EraConfig()) -> DataFrame:
    """E1 over an already built :func:`condition_target`."""
    e = summarize_eras(
        target, CONDITION_KEYS, COND_START, COND_END, cfg.grace_days,
        id_col=cfg.id_column("condition_occurrence_id"), measures=("ids",),
    )
    return condition_era_columns(e)


def condition_era_columns(e: DataFrame) -> DataFrame:
    """E1 columns from a :func:`summarize_eras` result."""
    return e.select(
        "person_id",
        "condition_concept_id",
        F.col("era_start").alias("condition_era_start_date"),
        F.col("era_end").alias("condition_era_end_date"),
        F.col("record_count").alias("condition_occurrence_count"),
    )


def condition_eras_by_type_from_target(target: DataFrame, cfg: EraConfig = EraConfig()) -> DataFrame:
    """E2 over a :func:`condition_target` built with ``with_type=True``."""
    e = summarize_eras(
        target, CONDITION_KEYS, COND_START, COND_END, cfg.grace_days,
        split="condition_type_concept_id", id_col=cfg.id_column("condition_occurrence_id"),
    )
    return condition_era_by_type_columns(e)


def condition_era_by_type_columns(e: DataFrame) -> DataFrame:
    """E2 columns from a :func:`summarize_eras` result split by condition type."""
    return e.select(
        "person_id",
        "condition_concept_id",
        F.col("era_start").alias("condition_era_start_date"),
        F.col("era_end").alias("condition_era_end_date"),
        "condition_type_concept_id",
        F.col("record_count").alias("condition_occurrence_count"),
    )


def drug_eras_from_target(
    target: DataFrame, cfg: EraConfig = EraConfig(), gap: str = "stockpile", weigh: bool = False
) -> DataFrame:
    """E3/E4 over an already built :func:`drug_target`; ``weigh`` for a stored
    one (see :func:`summarize_eras`)."""
    e = summarize_eras(
        target, DRUG_KEYS, DRUG_START, DRUG_END, cfg.grace_days,
        id_col=cfg.id_column("drug_exposure_id"), measures=gap_measures(gap), weigh=weigh,
    )
    return drug_era_columns(e, gap)


def drug_era_columns(e: DataFrame, gap: str = "stockpile") -> DataFrame:
    """E3/E4 columns from a :func:`summarize_eras` result. Stockpile eras count
    an exposure once per different length, covered eras once per id; ``both``
    carries the stockpile count as well."""
    if gap not in GAP_METHODS:
        raise ValueError(f"gap must be one of {GAP_METHODS}")
    stock = gap_days_stockpile("era_start", "era_end", "sum_days")
    cover = gap_days_covered("era_start", "era_end", "covered_days")
    gaps = {
        "stockpile": [stock.alias("gap_days")],
        "covered": [cover.alias("gap_days")],
        "both": [
            F.col("interval_count").alias("drug_exposure_count_stockpile"),
            stock.alias("gap_days_stockpile"),
            cover.alias("gap_days_covered"),
        ],
    }[gap]
    count = "interval_count" if gap == "stockpile" else "record_count"
    return e.select(
        "person_id",
        F.col("ingredient_concept_id").alias("drug_concept_id"),
        F.col("era_start").alias("drug_era_start_date"),
        F.col("era_end").alias("drug_era_end_date"),
        F.col(count).alias("drug_exposure_count"),
        *gaps,
    )


def drug_eras_by_type_from_target(target: DataFrame, cfg: EraConfig = EraConfig()) -> DataFrame:
    """E5 over a :func:`drug_target` that carries ``drug_type_concept_id``."""
    e = summarize_eras(
        target, DRUG_KEYS, DRUG_START, DRUG_END, cfg.grace_days,
        split="drug_type_concept_id", id_col=cfg.id_column("drug_exposure_id"),
    )
    return drug_era_by_type_columns(e)


def drug_era_by_type_columns(e: DataFrame) -> DataFrame:
    """E5 columns from a :func:`summarize_eras` result split by drug type."""
    return e.select(
        "person_id",
        F.col("ingredient_concept_id").alias("drug_concept_id"),
        F.col("era_start").alias("drug_era_start_date"),
        F.col("era_end").alias("drug_era_end_date"),
        "drug_type_concept_id",
        F.col("record_count").alias("drug_exposure_count"),
    )


def dose_eras_from_target(target: DataFrame, cfg: EraConfig = EraConfig()) -> DataFrame:
    """E6 over an already built :func:`dose_target`."""
    e = summarize_eras(target, DOSE_KEYS, DRUG_START, DRUG_END, cfg.grace_days)
    return e.select(
        "person_id",
        F.col("ingredient_concept_id").alias("drug_concept_id"),
        "unit_concept_id",
        "dose_value",
        F.col("era_start").alias("dose_era_start_date"),
        F.col("era_end").alias("dose_era_end_date"),
    )


def condition_era(condition_occurrence: DataFrame, cfg: EraConfig = EraConfig()) -> DataFrame:
    """E1: one row per (person, condition, run): first start, run end, count."""
    return condition_eras_from_target(condition_target(condition_occurrence, cfg), cfg)


def condition_era_by_type(
    condition_occurrence: DataFrame, cfg: EraConfig = EraConfig()
) -> DataFrame:
    """E2: runs as in E1, reported per condition type. The type is not a
    packing key: rows of one run share the run's end, and the start is the
    earliest start of that type. A NULL type is its own group."""
    t = condition_target(condition_occurrence, cfg, with_type=True)
    return condition_eras_by_type_from_target(t, cfg)


def drug_era(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    cfg: EraConfig = EraConfig(),
    gap: str = "stockpile",
    stored_target: DataFrame | None = None,
) -> DataFrame:
    """E3/E4: ingredient-level drug eras with ``gap_days``.

    ``gap="stockpile"``: era length minus summed exposure lengths (negative
    when supplies overlap). ``gap="covered"``: era length minus the days
    covered by at least one exposure. ``gap="both"`` returns both as
    ``gap_days_stockpile`` and ``gap_days_covered`` from the same single pass.

    ``stored_target`` is the :func:`drug_target` of these sources and this ``cfg``
    where it was written before, for more than one use: it is read, not built again.
    """
    if gap not in GAP_METHODS:
        raise ValueError(f"gap must be one of {GAP_METHODS}")
    if stored_target is not None:
        return drug_eras_from_target(stored_target, cfg, gap, weigh=True)
    t = drug_target(drug_exposure, concept_ancestor, concept, cfg)
    return drug_eras_from_target(t, cfg, gap)


def drug_era_by_type(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    cfg: EraConfig = EraConfig(),
) -> DataFrame:
    """E5: drug eras reported per drug type (no gap days), as E2 for drugs."""
    t = drug_target(drug_exposure, concept_ancestor, concept, cfg, extra=["drug_type_concept_id"])
    return drug_eras_by_type_from_target(t, cfg)


def dose_era(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    cfg: EraConfig = EraConfig(),
) -> DataFrame:
    """E6: runs per (person, ingredient, unit, dose). A change of dose or unit
    starts a separate run; runs of different doses may overlap in time.
    Records with a NULL unit or dose form no era."""
    return dose_eras_from_target(dose_target(drug_exposure, concept_ancestor, concept, cfg), cfg)
