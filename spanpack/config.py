"""Run-time parameters of the era builders.

Every knob the SQL scripts hard-code (grace window, default exposure length,
the vocabulary filter that selects ingredients, the optional row filters) is a
field here, so one frozen object travels through every operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

# Fixed values that must equal the original scripts for identical results.
DEFAULT_GRACE_DAYS = 30          # persistence window between neighbouring records
DEFAULT_EXPOSURE_DAYS = 1        # length given to a record with no end and no supply
DEFAULT_VOCABULARY_VALUE = 8     # vocabulary id compared in the ingredient filter
DEFAULT_CLASS_VALUE = "Ingredient"
DEFAULT_UNMAPPED_ID = 0          # concept id used for unmapped records

INVALID_POLICIES = ("quarantine", "clamp")


@dataclass(frozen=True)
class TableNames:
    """Catalog names of the inputs and outputs (the scripts' schema placeholders)."""

    drug_exposure: str = "drug_exposure"
    condition_occurrence: str = "condition_occurrence"
    concept_ancestor: str = "concept_ancestor"
    concept: str = "concept"
    condition_era: str = "condition_era"
    drug_era: str = "drug_era"
    dose_era: str = "dose_era"
    cdm_schema: str | None = None
    vocabulary_schema: str | None = None

    def qualified(self, name: str) -> str:
        """Return ``schema.table`` for a logical table name."""
        table = getattr(self, name)
        vocab = name in ("concept_ancestor", "concept")
        schema = self.vocabulary_schema if vocab and self.vocabulary_schema else self.cdm_schema
        return f"{schema}.{table}" if schema else table


@dataclass(frozen=True)
class EraConfig:
    grace_days: int = DEFAULT_GRACE_DAYS
    default_days: int = DEFAULT_EXPOSURE_DAYS
    # optional row filters, off by default as in the scripts
    exclude_unmapped: bool = False
    unmapped_id: Any = DEFAULT_UNMAPPED_ID
    require_nonneg_supply: bool = False
    # the scripts' ``days_supply >= 0`` also drops NULL supply; set True to keep it
    nonneg_supply_keeps_null: bool = False
    # what to do with intervals whose end precedes their start
    invalid: str = "quarantine"
    # a record id that repeats with one key and start counts once; True trusts
    # ids to be unique and counts rows, which saves two local aggregates
    assume_unique_ids: bool = False
    # where the ingredient map is too large to broadcast and one drug concept may hold
    # much of the exposures: count heavy concepts first and deal their records out
    spread_hot_concepts: bool = False
    # ingredient selection in the concept table
    vocabulary_column: str = "vocabulary_id"
    vocabulary_value: Any = DEFAULT_VOCABULARY_VALUE
    class_column: str = "concept_class"
    class_value: Any = DEFAULT_CLASS_VALUE
    tables: TableNames = field(default_factory=TableNames)

    def __post_init__(self) -> None:
        if self.invalid not in INVALID_POLICIES:
            raise ValueError(f"invalid must be one of {INVALID_POLICIES}, got {self.invalid!r}")
        if self.grace_days < 0 or self.default_days < 0:
            raise ValueError("grace_days and default_days must be >= 0")

    def id_column(self, name: str) -> str | None:
        """The id to count by, or None where rows are trusted to be unique."""
        return None if self.assume_unique_ids else name

    def with_(self, **changes: Any) -> "EraConfig":
        return replace(self, **changes)
