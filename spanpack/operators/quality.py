"""Data-quality operators.

Q1 ``reconcile_counts``: input (exposure x ingredient) records vs summed era
   counts; both sides are one-row aggregates, so the cross join is 1 x 1.
   ``audit_buckets``, ``audit_summary``, ``differing_keys``: the same for a stored
   table, by mergeable sums over key buckets that lead to the keys that differ.
Q2 ``quality_report``: one row per problem with the number of records that
   have it; computed as a single global aggregate (partial per task, one tiny
   final merge) and unpivoted, so it never groups records by a hot key.
``split_valid`` / ``quarantine``: the rows an era builder drops, with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanpack.config import EraConfig
from spanpack.functions.dates import condition_end_date, drug_end_date
from spanpack.operators.spread import split_by_weight
from spanpack.operators.targets import (
    COND_END,
    COND_START,
    DRUG_END,
    DRUG_START,
    dose_target,
    equals_value,
    ingredient_map,
    valid_interval,
)
from spanpack.schemas import as_date, require_columns


#: The mark of a row that breaks no rule.
VALID = "valid"


def invalid_reason(keys: list[str], start: str, end: str) -> Column:
    """The first failing check, in this order: NULL start, NULL end, NULL key
    (in key order), end before start."""
    checks = [(F.col(start).isNull(), "null_start_date"), (F.col(end).isNull(), "null_end_date")]
    checks += [(F.col(k).isNull(), f"null_{k}") for k in keys]
    checks.append((F.col(end) < F.col(start), "end_before_start"))
    reason = F.when(checks[0][0], F.lit(checks[0][1]))
    for cond, name in checks[1:]:
        reason = reason.when(cond, F.lit(name))
    return reason


def quarantine(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Rows that break the interval contract, with a ``reason`` column."""
    bad = df.filter(~F.coalesce(valid_interval(keys, start, end), F.lit(False)))
    return bad.withColumn("reason", invalid_reason(keys, start, end))


def split_valid(
    df: DataFrame, keys: list[str], start: str, end: str
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``reason``); both lazy over ``df``."""
    return df.filter(valid_interval(keys, start, end)), quarantine(df, keys, start, end)


def quality_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(reason, row_count) for each named boolean check, zero counts included."""
    totals = df.agg(
        *[F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(name) for name, cond in checks.items()]
    )
    rows = F.array(
        *[F.struct(F.lit(name).alias("reason"), F.col(name).alias("row_count")) for name in checks]
    )
    return totals.select(F.explode(rows).alias("r")).select(
        "r.reason", F.coalesce(F.col("r.row_count"), F.lit(0).cast("long")).alias("row_count")
    )


def condition_quality_report(
    condition_occurrence: DataFrame, cfg: EraConfig = EraConfig()
) -> DataFrame:
    """Q2 for conditions: what the era builder drops or what deserves a look."""
    co = condition_occurrence
    require_columns(co, ["person_id", "condition_concept_id", COND_START, COND_END], "condition_occurrence")
    start = as_date(co, COND_START)
    end = condition_end_date(start, as_date(co, COND_END), cfg.default_days)
    concept = F.col("condition_concept_id")
    return quality_report(co, {
        "null_person_id": F.col("person_id").isNull(),
        "null_start_date": start.isNull(),
        "null_concept_id": concept.isNull(),
        "unmapped_concept": equals_value(co, "condition_concept_id", cfg.unmapped_id),
        "end_before_start": end < start,
    })


def drug_quality_report(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    cfg: EraConfig = EraConfig(),
) -> DataFrame:
    """Q2 for drug exposures (one count per source record and problem)."""
    de = drug_exposure
    require_columns(
        de, ["person_id", "drug_concept_id", DRUG_START, DRUG_END, "days_supply"], "drug_exposure"
    )
    mapped = ingredient_map(concept_ancestor, concept, cfg).groupBy(
        F.col("descendant_concept_id").alias("_mapped_id")
    ).agg(F.count(F.lit(1)).alias("_ingredients"))
    flagged = de.join(mapped, F.col("drug_concept_id") == F.col("_mapped_id"), "left")
    start = as_date(de, DRUG_START)
    given = as_date(de, DRUG_END)
    supply = F.col("days_supply")
    end = drug_end_date(start, given, supply, cfg.default_days)
    concept_id = F.col("drug_concept_id")
    checks = {
        "null_person_id": F.col("person_id").isNull(),
        "null_start_date": start.isNull(),
        "null_concept_id": concept_id.isNull(),
        "unmapped_concept": equals_value(de, "drug_concept_id", cfg.unmapped_id),
        "no_ingredient": concept_id.isNotNull() & F.col("_mapped_id").isNull(),
        "negative_days_supply": supply < 0,
        "null_supply_with_end_date": supply.isNull() & given.isNotNull(),
        "end_before_start": end < start,
    }
    if "effective_drug_dose" in de.columns:
        checks["null_dose"] = F.col("effective_drug_dose").isNull()
    if "dose_unit_concept_id" in de.columns:
        checks["null_dose_unit"] = F.col("dose_unit_concept_id").isNull()
    return quality_report(flagged, checks)


def dose_quality_report(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    cfg: EraConfig = EraConfig(),
) -> DataFrame:
    """Q2 at the dose target grain (exposure x ingredient): the rows a dose
    era drops because the unit or the dose is NULL (SURVEY N4), and the rows
    it keeps."""
    t = dose_target(drug_exposure, concept_ancestor, concept, cfg)
    unit, dose = F.col("unit_concept_id"), F.col("dose_value")
    return quality_report(t, {
        "target_rows": F.lit(True),
        "null_dose_value": dose.isNull(),
        "null_unit": unit.isNull(),
        "dropped_null_unit_or_dose": unit.isNull() | dose.isNull(),
    })


def reconcile_counts(
    target: DataFrame, era: DataFrame, count_col: str, record: Sequence[str] | None = None
) -> DataFrame:
    """Q1: ``target_rows`` (records that entered packing) vs ``era_count_sum``
    (sum of ``count_col`` over the eras), and whether they match. Use the same
    target (same filters) that built ``era``.

    ``record`` names the columns that make one record (keys, start and id; for
    stockpile drug eras the end as well): rows that repeat them are one record,
    as in the eras. Without it every row counts."""
    rows = target.select(*record).distinct() if record else target
    left = rows.agg(F.count(F.lit(1)).alias("target_rows"))
    right = era.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("long").alias("era_count_sum"))
    return left.crossJoin(right).withColumn(
        "matches", F.col("target_rows") == F.col("era_count_sum")
    )


# ------------------------------------------------- audit of a stored table
#: Key buckets of an audit; a fixed number, whatever the tables' size.
AUDIT_BUCKETS = 4096


def record_counts(target: DataFrame, keys: Sequence[str], record: Sequence[str], weigh: bool = False) -> DataFrame:
    """(keys, ``n``): each key's records, those that repeat ``record`` once.

    ``record`` takes in the keys. ``weigh`` is for a target that is cheap to read
    again, as a stored one is: its rows travel once, by their keys, unless these are heavy."""
    def counts(rows: DataFrame) -> DataFrame:
        return rows.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    rows = target.select(*record)
    if not weigh:
        return counts(rows)
    ((light, heavy),) = split_by_weight([rows], keys)
    return counts(light.repartition(*keys)).unionByName(counts(heavy))


def stored_counts(era: DataFrame, keys: Sequence[str], count_col: str, rename: dict[str, str] | None = None) -> DataFrame:
    """(keys, ``n``): what a stored era table says, its columns renamed to the
    target's keys."""
    renamed = era.select(*[F.col(c).alias((rename or {}).get(c, c)) for c in era.columns])
    return renamed.groupBy(*keys).agg(F.sum(count_col).alias("n"))


def bucket_sums(counts: DataFrame, keys: Sequence[str], buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """(bucket, ``n_keys``, ``records``, ``digest``) of a count table. All are
    sums, so buckets of parts of a table add up to those of the whole."""
    h = F.xxhash64(*keys, F.col("n").cast("long")).cast("decimal(38,0)")
    return counts.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").cast("long").alias("records"), F.sum(h).alias("digest")
    )


def audit_buckets(expected: DataFrame, stored: DataFrame, keys: Sequence[str], buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """One row a bucket: keys and records on both sides, and whether they agree."""
    left = bucket_sums(expected, keys, buckets)
    right = bucket_sums(stored, keys, buckets)
    both = left.alias("l").join(right.alias("r"), "bucket", "full")
    zero = F.lit(0).cast("long")
    return both.select(
        "bucket",
        *[F.coalesce(F.col(f"{side}.{c}"), zero).alias(f"{name}_{c}") for side, name in (("l", "expected"), ("r", "stored")) for c in ("n_keys", "records")],
        F.coalesce(
            (F.col("l.digest") == F.col("r.digest")) & (F.col("l.n_keys") == F.col("r.n_keys")), F.lit(False)
        ).alias("matches"),
    )


def audit_summary(expected: DataFrame, stored: DataFrame, keys: Sequence[str], buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """One row: keys and records on both sides, buckets that differ, ``matches``."""
    return audit_buckets(expected, stored, keys, buckets).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("expected_n_keys", "stored_n_keys", "expected_records", "stored_records")],
        F.coalesce(F.min("matches"), F.lit(True)).alias("matches"),
    )


def differing_keys(expected: DataFrame, stored: DataFrame, keys: Sequence[str], buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """(keys, ``expected_count``, ``stored_count``) of the keys whose counts
    differ; 0 where a side lacks the key. Both count tables are taken once and
    compared key by key, so whatever they are computed from is read once;
    ``buckets`` has no part in the result."""
    zero = F.lit(0).cast("long")
    n = F.col("n").cast("long")
    left = expected.select(*keys, n.alias("expected_count"), zero.alias("stored_count"))
    right = stored.select(*keys, zero.alias("expected_count"), n.alias("stored_count"))
    both = left.union(right).groupBy(*keys)
    both = both.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("expected_count", "stored_count")])
    return both.where("expected_count <> stored_count")


def duplicate_id_report(df: DataFrame, id_cols: list[str] | tuple[str, ...]) -> DataFrame:
    """One row: how many ids occur more than once and how many surplus rows
    they bring. Record ids must be unique for era counts to be exact (see
    ``EraConfig.assume_unique_ids``). Partial aggregation collapses a repeated id
    on the map side, so a hot id does not overload one task."""
    per_id = df.groupBy(*id_cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return per_id.agg(
        F.count(F.lit(1)).alias("duplicate_ids"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
    )
