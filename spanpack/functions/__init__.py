"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from spanpack.functions.dates import (
    covered_days,
    days_between,
    drug_end_date,
    drug_end_source,
    condition_end_date,
    gap_days_covered,
    gap_days_stockpile,
    opens_new_run,
)

__all__ = [
    "covered_days",
    "days_between",
    "drug_end_date",
    "drug_end_source",
    "condition_end_date",
    "gap_days_covered",
    "gap_days_stockpile",
    "opens_new_run",
]
