"""Target builders: from source records to clean, packable intervals.

T1 ``normalize_drug_end``      end date from given end / supply / default day
T2 ``normalize_condition_end`` end date from given end / default day
T3 ``rollup_to_ingredient``    drug -> every ingredient ancestor (fan-out)
T4 ``filter_unmapped``         optional ``concept != unmapped_id``
T5 ``filter_nonneg_supply``    optional ``days_supply >= 0``

plus ``condition_target``, ``drug_target`` and ``dose_target``, which chain
them and enforce the interval contract of :mod:`spanpack.operators.packing`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanpack.config import EraConfig
from spanpack.functions.dates import condition_end_date, drug_end_date, drug_end_source
from spanpack.operators.spread import spread_join
from spanpack.schemas import as_date, require_columns

DRUG_KEYS = ["person_id", "ingredient_concept_id"]
DOSE_KEYS = ["person_id", "ingredient_concept_id", "unit_concept_id", "dose_value"]
CONDITION_KEYS = ["person_id", "condition_concept_id"]
DRUG_START, DRUG_END = "drug_exposure_start_date", "drug_exposure_end_date"
COND_START, COND_END = "condition_start_date", "condition_end_date"


# ---------------------------------------------------------------- T1, T2
def normalize_drug_end(
    df: DataFrame, default_days: int = 1, source_col: str | None = None
) -> DataFrame:
    """Replace ``drug_exposure_end_date`` by its normalised value (T1).

    With ``source_col`` also record which branch supplied it
    (``given`` / ``supply`` / ``default``).
    """
    require_columns(df, [DRUG_START, DRUG_END, "days_supply"], "normalize_drug_end")
    start = as_date(df, DRUG_START)
    given = as_date(df, DRUG_END)
    out = df.withColumn(DRUG_START, start)
    if source_col:
        out = out.withColumn(source_col, drug_end_source(given, F.col("days_supply")))
    return out.withColumn(DRUG_END, drug_end_date(start, given, F.col("days_supply"), default_days))


def normalize_condition_end(df: DataFrame, default_days: int = 1) -> DataFrame:
    """Replace ``condition_end_date`` by the given end or ``start + default_days`` (T2)."""
    require_columns(df, [COND_START, COND_END], "normalize_condition_end")
    start = as_date(df, COND_START)
    return df.withColumn(COND_START, start).withColumn(
        COND_END, condition_end_date(start, as_date(df, COND_END), default_days)
    )


# ---------------------------------------------------------------- T4, T5
_NO_VALUE = object()


def _typed_value(dtype: T.DataType, value):
    """``value`` in the Python form of ``dtype``, or ``_NO_VALUE`` when the
    type cannot hold it (so an integer id never meets a text column in an
    ANSI cast, and the predicate stays a plain literal comparison that
    Parquet can take as a pushed filter)."""
    if isinstance(dtype, T.StringType):
        return str(value)
    if isinstance(dtype, T.IntegralType):
        if isinstance(value, int) and not isinstance(value, bool):
            return value
        text = str(value).strip()
        return int(text) if text.lstrip("-").isdigit() else _NO_VALUE
    return value


def equals_value(df: DataFrame, column: str, value) -> Column:
    """``column == value`` with ``value`` taken in the column's own type; a
    value the type cannot hold matches nothing. NULL compares as NULL."""
    typed = _typed_value(df.schema[column].dataType, value)
    if typed is _NO_VALUE:
        return F.lit(False)
    return F.col(column) == F.lit(typed).cast(df.schema[column].dataType)


def filter_unmapped(df: DataFrame, column: str, unmapped_id=0) -> DataFrame:
    """Drop records whose concept is the unmapped id (T4). NULL concepts are
    kept here; they never form an era because NULL keys are dropped."""
    return df.filter(F.col(column).isNull() | ~equals_value(df, column, unmapped_id))


def filter_nonneg_supply(df: DataFrame, keep_null: bool = False) -> DataFrame:
    """Keep ``days_supply >= 0`` (T5).

    SQL three-valued logic makes the plain predicate drop NULL supply too,
    even when an end date is given; ``keep_null=True`` keeps those rows.
    """
    ok = F.col("days_supply") >= 0
    return df.filter(ok | F.col("days_supply").isNull()) if keep_null else df.filter(ok)


# ---------------------------------------------------------------- T3
def ingredients(concept: DataFrame, cfg: EraConfig = EraConfig()) -> DataFrame:
    """Concept ids that are ingredients of the configured vocabulary."""
    require_columns(concept, ["concept_id", cfg.vocabulary_column, cfg.class_column], "concept")
    sel = equals_value(concept, cfg.vocabulary_column, cfg.vocabulary_value) & equals_value(
        concept, cfg.class_column, cfg.class_value
    )
    return concept.filter(sel).select(F.col("concept_id").alias("ingredient_concept_id"))


def ingredient_map(
    concept_ancestor: DataFrame, concept: DataFrame, cfg: EraConfig = EraConfig()
) -> DataFrame:
    """(descendant_concept_id, ingredient_concept_id): each drug concept with
    every ingredient among its ancestors. De-duplicated, so a repeated
    ancestor row cannot double-count an exposure. Spark decides by its own
    size threshold and at run time whether the map is broadcast."""
    require_columns(
        concept_ancestor, ["ancestor_concept_id", "descendant_concept_id"], "concept_ancestor"
    )
    pairs = concept_ancestor.join(
        ingredients(concept, cfg), F.col("ancestor_concept_id") == F.col("ingredient_concept_id")
    )
    return pairs.select("descendant_concept_id", "ingredient_concept_id").distinct()


def rollup_to_ingredient(
    exposure: DataFrame,
    concept_ancestor: DataFrame | None = None,
    concept: DataFrame | None = None,
    cfg: EraConfig = EraConfig(),
    mapping: DataFrame | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Replace each drug by every ingredient ancestor (T3): adds
    ``ingredient_concept_id``; a combination drug fans out to one row per
    ingredient and a drug without an ingredient ancestor disappears.

    ``mapping`` (from :func:`ingredient_map`) skips rebuilding the map when
    several targets share it. ``cfg.spread_hot_concepts`` joins by
    :func:`spanpack.operators.spread.spread_join`, whose tasks stay even
    however many records one drug concept holds, at one more read of the
    concept column, from ``counted`` if given (see there)."""
    require_columns(exposure, ["drug_concept_id"], "drug_exposure")
    if mapping is None:
        mapping = ingredient_map(concept_ancestor, concept, cfg)
    if cfg.spread_hot_concepts:
        joined = spread_join(exposure, mapping, "drug_concept_id", "descendant_concept_id", counted=counted)
    else:
        joined = exposure.join(mapping, F.col("drug_concept_id") == F.col("descendant_concept_id"))
    return joined.drop("descendant_concept_id")


# ---------------------------------------------------------------- validity
def valid_interval(keys: list[str], start: str, end: str) -> Column:
    cond = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def enforce_valid(df: DataFrame, keys: list[str], start: str, end: str, policy: str) -> DataFrame:
    """Apply the invalid-interval policy: ``quarantine`` drops rows with a
    NULL key/start or ``end < start`` (see :mod:`spanpack.operators.quality`
    for the report of what was dropped); ``clamp`` sets ``end = start`` first."""
    if policy == "clamp":
        df = df.withColumn(end, F.greatest(F.col(end), F.col(start)))
    return df.filter(valid_interval(keys, start, end))


# ---------------------------------------------------------------- targets
def condition_target(
    condition_occurrence: DataFrame, cfg: EraConfig = EraConfig(), with_type: bool = False
) -> DataFrame:
    """Clean condition intervals: id, person, concept, [type], start, end."""
    cols = ["condition_occurrence_id", "person_id", "condition_concept_id"]
    cols += ["condition_type_concept_id"] if with_type else []
    require_columns(condition_occurrence, cols + [COND_START, COND_END], "condition_occurrence")
    df = condition_occurrence.select(*cols, COND_START, COND_END)
    if cfg.exclude_unmapped:
        df = filter_unmapped(df, "condition_concept_id", cfg.unmapped_id)
    df = normalize_condition_end(df, cfg.default_days)
    return enforce_valid(df, CONDITION_KEYS, COND_START, COND_END, cfg.invalid)


def _drug_source(drug_exposure: DataFrame, cfg: EraConfig, extra: list[str]) -> DataFrame:
    cols = ["drug_exposure_id", "person_id", "drug_concept_id", *extra]
    require_columns(drug_exposure, cols + [DRUG_START, DRUG_END, "days_supply"], "drug_exposure")
    df = drug_exposure.select(*cols, DRUG_START, DRUG_END, "days_supply")
    if cfg.exclude_unmapped:
        df = filter_unmapped(df, "drug_concept_id", cfg.unmapped_id)
    if cfg.require_nonneg_supply:
        df = filter_nonneg_supply(df, cfg.nonneg_supply_keeps_null)
    return normalize_drug_end(df, cfg.default_days)


def drug_target(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame | None,
    concept: DataFrame | None,
    cfg: EraConfig = EraConfig(),
    extra: list[str] | tuple[str, ...] = (),
    mapping: DataFrame | None = None,
) -> DataFrame:
    """Clean (exposure x ingredient) intervals: id, person, ingredient,
    [extra], start, end, days_supply."""
    df = _drug_source(drug_exposure, cfg, list(extra))
    df = enforce_valid(df, ["person_id"], DRUG_START, DRUG_END, cfg.invalid)
    # the dates and supply that make a record valid need not be read to count concepts
    counted = filter_unmapped(drug_exposure, "drug_concept_id", cfg.unmapped_id) if cfg.exclude_unmapped else drug_exposure
    df = rollup_to_ingredient(df, concept_ancestor, concept, cfg, mapping=mapping, counted=counted)
    return df.select(
        "drug_exposure_id", "person_id", "ingredient_concept_id", *extra,
        DRUG_START, DRUG_END, "days_supply",
    )


def dose_target(
    drug_exposure: DataFrame,
    concept_ancestor: DataFrame | None,
    concept: DataFrame | None,
    cfg: EraConfig = EraConfig(),
    mapping: DataFrame | None = None,
) -> DataFrame:
    """:func:`drug_target` with ``unit_concept_id`` and ``dose_value``.

    Rows with a NULL unit or dose stay in the target but never form a dose
    era (NULL packing keys are dropped); the quality report counts them.
    """
    t = drug_target(
        drug_exposure, concept_ancestor, concept, cfg,
        extra=["dose_unit_concept_id", "effective_drug_dose"], mapping=mapping,
    )
    return t.withColumnRenamed("dose_unit_concept_id", "unit_concept_id").withColumnRenamed(
        "effective_drug_dose", "dose_value"
    )
