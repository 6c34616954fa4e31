"""

Every query reads the driver's tables from ``sf_dir`` and maps them onto the
clinical source schemas (``spanpack.sources.fixtures``), then runs a library
operator over the whole tables. The oracle SQL builds the same sources in
DuckDB and computes eras independently: a running open-count sweep over
start/end events finds era ends, each record takes the earliest era end on or
after its start, and covered days are counted by enumerating days. The Spark
side uses the day-level gaps-and-islands window of ``spanpack``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanpack import (
    EraConfig,
    assign_era_end,
    attach_run_ends,
    audit_summary,
    condition_era,
    condition_era_by_type,
    condition_quality_report,
    condition_target,
    differing_keys,
    dose_era,
    dose_quality_report,
    drug_era,
    drug_era_by_type,
    drug_quality_report,
    drug_target,
    duplicate_id_report,
    era_end_dates,
    filter_nonneg_supply,
    merge_overlaps,
    normalize_condition_end,
    normalize_drug_end,
    pack_intervals,
    reconcile_counts,
    record_counts,
    stored_counts,
    sub_exposure_days,
    summarize_eras,
)
from spanpack.checkpoint import checkpoint_dir
from spanpack.functions import gap_days_covered, gap_days_stockpile
from spanpack.sources import (
    fixtures as fx,
    load_sources,
    publish_split,
    publish_version,
    read_era_table,
    read_split,
    read_version,
)

SMOKE_DIR = "/root/testdata/sf0.001"
UNMAPPED_CONDITION = "4-NOT SPECIFIED"   # fixture value treated as "unmapped"
EVENT_GRACE_DAYS = 2

COND_KEYS = ["person_id", "condition_concept_id"]
DRUG_KEYS = ["person_id", "ingredient_concept_id"]
# what makes one record of a stockpile drug era, and of a condition era
DRUG_RECORD = [*DRUG_KEYS, "drug_exposure_start_date", "drug_exposure_end_date", "drug_exposure_id"]
COND_RECORD = [*COND_KEYS, "condition_start_date", "condition_occurrence_id"]
STORED_DRUG = {"drug_concept_id": "ingredient_concept_id"}
LOST_MOD = 97                    # persons whose stored eras count one too few, in the audit's test


# ----------------------------------------------------------------- queries
def _condition_era(spark: SparkSession, d: str) -> DataFrame:
    return condition_era(fx.condition_occurrence(spark, d))


def _condition_era_by_type(spark: SparkSession, d: str) -> DataFrame:
    return condition_era_by_type(fx.condition_occurrence(spark, d))


def _drug_era_stockpile(spark: SparkSession, d: str) -> DataFrame:
    return drug_era(*fx.drug_sources(spark, d), gap="stockpile")


def _drug_era_covered(spark: SparkSession, d: str) -> DataFrame:
    return drug_era(*fx.drug_sources(spark, d), gap="covered")


def _drug_era_both_gaps(spark: SparkSession, d: str) -> DataFrame:
    return drug_era(*fx.drug_sources(spark, d), gap="both")


def _drug_era_by_type(spark: SparkSession, d: str) -> DataFrame:
    return drug_era_by_type(*fx.drug_sources(spark, d))


def _dose_era(spark: SparkSession, d: str) -> DataFrame:
    return dose_era(*fx.drug_sources(spark, d))


def _drug_end_normalized(spark: SparkSession, d: str) -> DataFrame:
    de = normalize_drug_end(fx.drug_exposure(spark, d), source_col="end_source")
    return de.select(
        "drug_exposure_id", "drug_exposure_start_date", "drug_exposure_end_date", "end_source"
    )


def _condition_end_normalized(spark: SparkSession, d: str) -> DataFrame:
    co = normalize_condition_end(fx.condition_occurrence(spark, d))
    return co.select("condition_occurrence_id", "condition_start_date", "condition_end_date")


ROLLUP_COLUMNS = (
    "drug_exposure_id", "person_id", "ingredient_concept_id",
    "drug_exposure_start_date", "drug_exposure_end_date",
)
SPREAD = EraConfig(spread_hot_concepts=True)


def _ingredient_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = drug_target(*fx.drug_sources(spark, d))
    return t.select(*ROLLUP_COLUMNS)


def _condition_era_mapped_only(spark: SparkSession, d: str) -> DataFrame:
    cfg = EraConfig(exclude_unmapped=True, unmapped_id=UNMAPPED_CONDITION)
    return condition_era(fx.condition_occurrence(spark, d), cfg)


def _drug_exposure_nonneg_supply(spark: SparkSession, d: str) -> DataFrame:
    de = filter_nonneg_supply(fx.drug_exposure(spark, d))
    return de.select("drug_exposure_id", "person_id", "days_supply")


def _condition_target(spark: SparkSession, d: str) -> DataFrame:
    return condition_target(fx.condition_occurrence(spark, d))


def _pack_intervals(spark: SparkSession, d: str) -> DataFrame:
    t = _condition_target(spark, d)
    return pack_intervals(t, COND_KEYS, "condition_start_date", "condition_end_date")


def _era_end_dates(spark: SparkSession, d: str) -> DataFrame:
    t = drug_target(*fx.drug_sources(spark, d))
    return era_end_dates(t, DRUG_KEYS, "drug_exposure_start_date", "drug_exposure_end_date")


def _assign_era_end(spark: SparkSession, d: str) -> DataFrame:
    t = drug_target(*fx.drug_sources(spark, d))
    out = assign_era_end(t, DRUG_KEYS, "drug_exposure_start_date", "drug_exposure_end_date")
    return out.select(
        "drug_exposure_id", "person_id", "ingredient_concept_id",
        "drug_exposure_start_date", "era_end_date",
    )


def _merge_overlaps(spark: SparkSession, d: str) -> DataFrame:
    t = drug_target(*fx.drug_sources(spark, d))
    return merge_overlaps(t, DRUG_KEYS, "drug_exposure_start_date", "drug_exposure_end_date")


def _sub_exposure_days(spark: SparkSession, d: str) -> DataFrame:
    t = drug_target(*fx.drug_sources(spark, d))
    return sub_exposure_days(t, DRUG_KEYS, "drug_exposure_start_date", "drug_exposure_end_date")


def _condition_gap(which: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = _condition_target(spark, d)
        e = summarize_eras(t, COND_KEYS, "condition_start_date", "condition_end_date", EraConfig().grace_days)
        gap = (
            gap_days_stockpile("era_start", "era_end", "sum_days")
            if which == "stockpile"
            else gap_days_covered("era_start", "era_end", "covered_days")
        )
        return e.select(
            *COND_KEYS,
            F.col("era_start").alias("condition_era_start_date"),
            F.col("era_end").alias("condition_era_end_date"),
            gap.alias("gap_days"),
        )

    return run


def _reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    srcs = fx.drug_sources(spark, d)
    return reconcile_counts(drug_target(*srcs), drug_era(*srcs), "drug_exposure_count", DRUG_RECORD)


def _drug_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return drug_quality_report(*fx.drug_sources(spark, d))


def _condition_quality_report(spark: SparkSession, d: str) -> DataFrame:
    cfg = EraConfig(unmapped_id=UNMAPPED_CONDITION)
    return condition_quality_report(fx.condition_occurrence(spark, d), cfg)


def _dose_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return dose_quality_report(*fx.drug_sources(spark, d))


def _drug_exposure_duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_id_report(fx.drug_exposure(spark, d), ["drug_exposure_id"])


def _event_era_grace2(spark: SparkSession, d: str) -> DataFrame:
    ev = fx.event_intervals(spark, d)
    e = summarize_eras(ev, ["user_id", "event_type"], "start_date", "end_date", EVENT_GRACE_DAYS)
    return e.select(
        "user_id", "event_type",
        F.col("era_start").alias("era_start_date"),
        F.col("era_end").alias("era_end_date"),
        F.col("record_count").alias("event_count"),
    )


def _repeated_drugs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.repeated_exposures(spark, d), *fx.drug_sources(spark, d)[1:]


def _hot_drugs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.hot_exposures(spark, d), *fx.drug_sources(spark, d)[1:]


def _drug_era_filtered(spark: SparkSession, d: str) -> DataFrame:
    """T4 and T5 within a drug build: one drug counts as unmapped, and rows
    without a supply of 0 or more go."""
    cfg = EraConfig(exclude_unmapped=True, unmapped_id=1, require_nonneg_supply=True)
    return drug_era(*fx.drug_sources(spark, d), cfg, gap="covered")


def _dose_era_fine_doses(spark: SparkSession, d: str) -> DataFrame:
    eras = dose_era(fx.fine_doses(spark, d), *fx.drug_sources(spark, d)[1:])
    return eras.withColumn("dose_value", F.col("dose_value").cast("double"))


# ------------------------------------------- stored tables, dirty sources
def _new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder; a local session without
    one gets a temporary folder."""
    shared = checkpoint_dir(spark)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spanpack-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, eras: DataFrame, name: str) -> DataFrame:
    path = _new_folder(spark, name)
    publish_version(eras, path)
    return read_era_table(spark, name, path=path)


def _stored_target(spark: SparkSession, srcs: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """The records of a drug target, written once for the eras and for what is held against them."""
    path = _new_folder(spark, "drug_target")
    publish_version(drug_target(*srcs).select(*DRUG_RECORD), path, sort_within=None, compression="zstd")
    return read_version(spark, path)


def _attach_stored_eras(spark: SparkSession, d: str) -> DataFrame:
    """P3 against stored eras: their ends are read, not computed again."""
    srcs = fx.drug_sources(spark, d)
    target = _stored_target(spark, srcs)
    eras = _stored(spark, drug_era(*srcs, stored_target=target), "drug_era")
    ends = eras.select("person_id", F.col("drug_concept_id").alias("ingredient_concept_id"), F.col("drug_era_end_date").alias("era_end_date"))
    records = target.select("drug_exposure_id", *DRUG_KEYS, "drug_exposure_start_date")
    out = attach_run_ends(records, ends, DRUG_KEYS, "drug_exposure_start_date", "era_end_date", weigh=True)
    return out.select("drug_exposure_id", "person_id", "ingredient_concept_id", "drug_exposure_start_date", "era_end_date")


def _drug_audit(spark: SparkSession, d: str, lost: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The records of each key, and what a stored table of their eras says, less those ``lost``."""
    srcs = _repeated_drugs(spark, d)
    target = _stored_target(spark, srcs)
    eras = drug_era(*srcs, stored_target=target)
    if lost is not None:
        eras = eras.withColumn("drug_exposure_count", F.col("drug_exposure_count") - lost)
    expected = record_counts(target, DRUG_KEYS, DRUG_RECORD, weigh=True)
    return expected, stored_counts(_stored(spark, eras, "drug_era"), DRUG_KEYS, "drug_exposure_count", STORED_DRUG)


def _stored_drug_era_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit_summary(*_drug_audit(spark, d), DRUG_KEYS)


def _stored_condition_era_audit(spark: SparkSession, d: str) -> DataFrame:
    co = fx.repeated_conditions(spark, d)
    stored = _stored(spark, condition_era(co), "condition_era")
    return audit_summary(
        record_counts(condition_target(co), COND_KEYS, COND_RECORD),
        stored_counts(stored, COND_KEYS, "condition_occurrence_count"), COND_KEYS)


def _stored_drug_era_faults(spark: SparkSession, d: str) -> DataFrame:
    """A stored table that counts one too few for some persons: the audit finds which."""
    short = (F.col("person_id") % LOST_MOD == 0).cast("int")
    return differing_keys(*_drug_audit(spark, d, short), DRUG_KEYS)


def _condition_era_appended_twice(spark: SparkSession, d: str) -> DataFrame:
    """K2: the same batches appended twice leave one copy of the eras."""
    path = _new_folder(spark, "condition_era")
    eras = condition_era(fx.condition_occurrence(spark, d))
    for batch in ("0", "1", "0", "1"):
        publish_version(eras.where(F.col("person_id") % 2 == int(batch)), path, mode="append", batch=batch)
    return read_era_table(spark, "condition_era", path=path)


def _drug_era_from_files(spark: SparkSession, d: str) -> DataFrame:
    """S1-S4: the sources written as files and read back by path."""
    folder = _new_folder(spark, "sources")
    tables = dict(zip(("drug_exposure", "concept_ancestor", "concept"), fx.drug_sources(spark, d)), condition_occurrence=fx.condition_occurrence(spark, d))
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    src = load_sources(spark, paths={n: f"{folder}/{n}" for n in tables})
    return drug_era(src["drug_exposure"], src["concept_ancestor"], src["concept"], gap="covered")


def _dirty_drugs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.dirty_exposures(spark, d), *fx.drug_sources(spark, d)[1:]


def _drug_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Clean and quarantined exposures written in one pass; the latter read back."""
    path = _new_folder(spark, "exposures")
    rows = normalize_drug_end(fx.dirty_exposures(spark, d))
    publish_split(rows, ["person_id", "drug_concept_id"], "drug_exposure_start_date", "drug_exposure_end_date", path)
    return read_split(spark, path)[1].select("drug_exposure_id", "person_id", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date", "reason")


def _condition_quarantine(spark: SparkSession, d: str) -> DataFrame:
    path = _new_folder(spark, "conditions")
    rows = normalize_condition_end(fx.dirty_conditions(spark, d))
    publish_split(rows, COND_KEYS, "condition_start_date", "condition_end_date", path)
    return read_split(spark, path)[1].select("condition_occurrence_id", *COND_KEYS, "condition_start_date", "condition_end_date", "reason")


def _dirty_nonneg_supply(spark: SparkSession, d: str) -> DataFrame:
    return filter_nonneg_supply(fx.dirty_exposures(spark, d)).select("drug_exposure_id", "person_id", "days_supply")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # E1-E6
    "condition_era": _condition_era,
    "condition_era_by_type": _condition_era_by_type,
    "drug_era_stockpile": _drug_era_stockpile,
    "drug_era_covered": _drug_era_covered,
    "drug_era_both_gaps": _drug_era_both_gaps,
    "drug_era_by_type": _drug_era_by_type,
    "dose_era": _dose_era,
    "dose_era_fine_doses": _dose_era_fine_doses,
    "drug_era_filtered": _drug_era_filtered,
    # A6: ids that repeat
    "condition_era_repeated_ids": lambda s, d: condition_era(fx.repeated_conditions(s, d)),
    "condition_era_by_type_repeated_ids": lambda s, d: condition_era_by_type(fx.repeated_conditions(s, d)),
    "drug_era_stockpile_repeated_ids": lambda s, d: drug_era(*_repeated_drugs(s, d), gap="stockpile"),
    "drug_era_covered_repeated_ids": lambda s, d: drug_era(*_repeated_drugs(s, d), gap="covered"),
    "drug_era_by_type_repeated_ids": lambda s, d: drug_era_by_type(*_repeated_drugs(s, d)),
    # T1-T5
    "drug_end_normalized": _drug_end_normalized,
    "condition_end_normalized": _condition_end_normalized,
    "ingredient_rollup": _ingredient_rollup,
    "condition_era_mapped_only": _condition_era_mapped_only,
    "drug_exposure_nonneg_supply": _drug_exposure_nonneg_supply,
    # P1-P5
    "pack_intervals": _pack_intervals,
    "era_end_dates": _era_end_dates,
    "assign_era_end": _assign_era_end,
    "merge_overlaps": _merge_overlaps,
    "sub_exposure_days": _sub_exposure_days,
    # G1, G2 on condition eras
    "condition_gap_stockpile": _condition_gap("stockpile"),
    "condition_gap_covered": _condition_gap("covered"),
    # Q1, Q2
    "reconcile_counts": _reconcile_counts,
    "drug_quality_report": _drug_quality_report,
    "condition_quality_report": _condition_quality_report,
    "dose_quality_report": _dose_quality_report,
    "drug_exposure_duplicate_ids": _drug_exposure_duplicate_ids,
    # P3 against stored run ends; Q1 on stored tables; K2; S1-S4
    "attach_stored_eras": _attach_stored_eras,
    "stored_drug_era_audit": _stored_drug_era_audit,
    "stored_condition_era_audit": _stored_condition_era_audit,
    "stored_drug_era_faults": _stored_drug_era_faults,
    # one drug concept with a third of the exposures and more
    "ingredient_rollup_hot_concept": lambda s, d: drug_target(*_hot_drugs(s, d), SPREAD).select(*ROLLUP_COLUMNS),
    "drug_era_hot_concept": lambda s, d: drug_era(*_hot_drugs(s, d), SPREAD, gap="both"),
    "dose_era_hot_concept": lambda s, d: dose_era(*_hot_drugs(s, d), SPREAD),
    "condition_era_appended_twice": _condition_era_appended_twice,
    "drug_era_from_files": _drug_era_from_files,
    # sources with faults of every kind
    "drug_quarantine": _drug_quarantine,
    "condition_quarantine": _condition_quarantine,
    "dirty_drug_era_by_type": lambda s, d: drug_era_by_type(*_dirty_drugs(s, d)),
    "dirty_drug_era_clamped": lambda s, d: drug_era(*_dirty_drugs(s, d), EraConfig(invalid="clamp"), gap="covered"),
    "dirty_condition_era_by_type": lambda s, d: condition_era_by_type(fx.dirty_conditions(s, d)),
    "dirty_condition_era_clamped": lambda s, d: condition_era(fx.dirty_conditions(s, d), EraConfig(invalid="clamp")),
    "dirty_dose_era": lambda s, d: dose_era(*_dirty_drugs(s, d)),
    "dirty_nonneg_supply": _dirty_nonneg_supply,
    "dirty_drug_quality_report": lambda s, d: drug_quality_report(*_dirty_drugs(s, d)),
    "dirty_condition_quality_report": lambda s, d: condition_quality_report(fx.dirty_conditions(s, d)),
    "dirty_dose_quality_report": lambda s, d: dose_quality_report(*_dirty_drugs(s, d)),
    # packing with a non-default grace over the events table
    "event_era_grace2": _event_era_grace2,
}


# The training-data operators and their pipeline are one optional part: they
# are registered if they are there. What they fail to import is an error.
_LLM = find_spec("spanpack.llm") is not None and find_spec("corpus_pipeline") is not None
if _LLM:
    import corpus_pipeline
    from spanpack.llm import queries as llm_queries

    _QUERIES |= llm_queries.queries()
    _QUERIES["pipeline"] = corpus_pipeline.run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: drug eras with both gap-day definitions from one pass."""
    return _drug_era_both_gaps(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# -------------------------------------------------------------- oracle SQL
_SOURCES = """
co AS (
  SELECT o_orderkey AS condition_occurrence_id,
         o_custkey AS person_id,
         o_orderpriority AS condition_concept_id,
         o_orderstatus AS condition_type_concept_id,
         CAST(o_orderdate AS DATE) AS condition_start_date,
         CASE WHEN o_orderkey % 3 <> 0
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) END AS condition_end_date
  FROM orders),
ct AS (
  SELECT condition_occurrence_id, person_id, condition_concept_id, condition_type_concept_id,
         condition_start_date AS s,
         COALESCE(condition_end_date, condition_start_date + 1) AS e
  FROM co),
de AS (
  SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')) AS drug_exposure_id,
         o_custkey AS person_id,
         l_partkey AS drug_concept_id,
         l_returnflag AS drug_type_concept_id,
         CAST(l_shipdate AS DATE) AS drug_exposure_start_date,
         CASE WHEN l_linenumber = 1
              THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS drug_exposure_end_date,
         CASE WHEN l_returnflag = 'R' THEN NULL
              ELSE CAST(l_quantity AS INTEGER) % 40 END AS days_supply,
         l_linestatus AS dose_unit_concept_id,
         CASE WHEN l_discount = 0 THEN NULL
              ELSE CAST(ceil(l_quantity / 25) AS DECIMAL(18,2)) END AS effective_drug_dose
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ca AS (
  SELECT p_type AS ancestor_concept_id, p_partkey AS descendant_concept_id FROM part
  UNION ALL SELECT p_brand, p_partkey FROM part
  UNION ALL SELECT CASE WHEN p_type = 'PROMO' THEN 'SMALL' ELSE 'PROMO' END, p_partkey
            FROM part WHERE p_size % 5 = 0),
cc AS (
  SELECT DISTINCT p_type AS concept_id, 8 AS vocabulary_id, 'Ingredient' AS concept_class FROM part
  UNION ALL
  SELECT DISTINCT p_brand, 8, 'Brand Name' FROM part),
ing AS (
  SELECT DISTINCT ca.descendant_concept_id, ca.ancestor_concept_id AS ingredient_concept_id
  FROM ca JOIN cc ON ca.ancestor_concept_id = cc.concept_id
  WHERE cc.vocabulary_id = 8 AND cc.concept_class = 'Ingredient'),
den AS (
  SELECT *,
         COALESCE(drug_exposure_end_date,
                  CASE WHEN days_supply <> 0 THEN drug_exposure_start_date + days_supply END,
                  drug_exposure_start_date + 1) AS norm_end,
         CASE WHEN drug_exposure_end_date IS NOT NULL THEN 'given'
              WHEN days_supply <> 0 THEN 'supply'
              ELSE 'default' END AS end_source
  FROM de),
dt AS (
  SELECT d.drug_exposure_id, d.person_id, m.ingredient_concept_id, d.drug_type_concept_id,
         d.dose_unit_concept_id AS unit_concept_id, d.effective_drug_dose AS dose_value,
         d.drug_exposure_start_date AS s, d.norm_end AS e
  FROM den d JOIN ing m ON d.drug_concept_id = m.descendant_concept_id
  WHERE d.person_id IS NOT NULL AND d.drug_exposure_start_date IS NOT NULL
    AND d.norm_end >= d.drug_exposure_start_date)"""


def _sweep(src: str, keys: list[str], grace: int, p: str) -> str:
    """CTEs ``{p}_ends`` (keys, era_end) and ``{p}_rows`` (src rows + era_end).

    Open-count sweep: +1 at each start, -1 at each end padded by ``grace``;
    on one date starts come before ends, so a start on a padded end joins.
    An era ends where the count returns to zero.
    """
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    on = " AND ".join(f"x.{c} = r.{c}" for c in keys)
    return f"""
{p}_src AS (SELECT * FROM {src} WHERE {nn}),
{p}_ev AS (
  SELECT {k}, s AS d, 0 AS kind, 1 AS delta FROM {p}_src
  UNION ALL
  SELECT {k}, e + {grace} AS d, 1 AS kind, -1 AS delta FROM {p}_src),
{p}_open AS (
  SELECT {k}, d, kind,
         SUM(delta) OVER (PARTITION BY {k} ORDER BY d, kind
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_open
  FROM {p}_ev),
{p}_ends AS (
  SELECT DISTINCT {k}, CAST(d - {grace} AS DATE) AS era_end FROM {p}_open WHERE kind = 1 AND n_open = 0),
{p}_rows AS (
  SELECT r.*, (SELECT MIN(x.era_end) FROM {p}_ends x WHERE {on} AND x.era_end >= r.s) AS era_end
  FROM {p}_src r)"""


def _covered(rows: str, keys: list[str], p: str) -> str:
    """CTE ``{p}_cov`` (keys, era_end, covered): distinct days [s, e) covered."""
    k = ", ".join(keys)
    return f"""
{p}_days AS (
  SELECT {k}, era_end, s, unnest(range(0, CAST(e - s AS BIGINT))) AS i FROM {rows}),
{p}_cov AS (
  SELECT {k}, era_end, COUNT(DISTINCT s + CAST(i AS INTEGER)) AS covered
  FROM {p}_days GROUP BY {k}, era_end)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


_COND_SWEEP = _sweep("ct", COND_KEYS, 30, "c")
_DRUG_SWEEP = _sweep("dt", DRUG_KEYS, 30, "g")
_DOSE_KEYS = ["person_id", "ingredient_concept_id", "unit_concept_id", "dose_value"]


# The same sources with ids that repeat (see spanpack.sources.fixtures).
_REPEATED = _SOURCES.replace("\nco AS (", "\nco_once AS (").replace("\nde AS (", "\nde_once AS (").replace("\nct AS (", """
co AS (
  SELECT * FROM co_once
  UNION ALL SELECT * FROM co_once WHERE condition_occurrence_id % 4 = 0
  UNION ALL SELECT * REPLACE (COALESCE(condition_end_date, condition_start_date) + 9 AS condition_end_date)
            FROM co_once WHERE condition_occurrence_id % 4 = 1
  UNION ALL SELECT * REPLACE ('Z' AS condition_type_concept_id) FROM co_once WHERE condition_occurrence_id % 4 = 2),
ct AS (""").replace("\nca AS (", """
de AS (
  SELECT * FROM de_once
  UNION ALL SELECT * FROM de_once WHERE CAST(split_part(drug_exposure_id, '|', 2) AS INTEGER) % 3 = 1
  UNION ALL SELECT * REPLACE (days_supply + 7 AS days_supply, drug_exposure_end_date + 7 AS drug_exposure_end_date)
            FROM de_once WHERE CAST(split_part(drug_exposure_id, '|', 2) AS INTEGER) % 3 = 2
  UNION ALL SELECT * REPLACE ('Z' AS drug_type_concept_id)
            FROM de_once WHERE CAST(split_part(drug_exposure_id, '|', 2) AS INTEGER) % 3 = 0),
ca AS (""")


# The same sources with faults (see spanpack.sources.fixtures). ``ct`` keeps all rows.
_DIRTY = _SOURCES.replace("\nco AS (", "\nco_once AS (").replace("\nde AS (", "\nde_once AS (").replace("\nct AS (", """
co AS (
  SELECT * REPLACE (
    CASE WHEN condition_occurrence_id % 13 = 0 THEN NULL ELSE person_id END AS person_id,
    CASE WHEN condition_occurrence_id % 13 = 1 THEN NULL ELSE condition_start_date END AS condition_start_date,
    CASE condition_occurrence_id % 13 WHEN 2 THEN NULL WHEN 3 THEN '0' ELSE condition_concept_id END AS condition_concept_id,
    CASE WHEN condition_occurrence_id % 13 = 4 THEN NULL ELSE condition_type_concept_id END AS condition_type_concept_id,
    CASE WHEN condition_occurrence_id % 13 = 5 THEN condition_start_date - 4 ELSE condition_end_date END AS condition_end_date)
  FROM co_once),
ct AS (""").replace("\nca AS (", """
de AS (
  SELECT * REPLACE (
    CASE WHEN drug_concept_id % 13 = 0 THEN NULL ELSE person_id END AS person_id,
    CASE WHEN drug_concept_id % 13 = 1 THEN NULL ELSE drug_exposure_start_date END AS drug_exposure_start_date,
    CASE drug_concept_id % 13 WHEN 2 THEN NULL WHEN 3 THEN 0 WHEN 4 THEN -5 ELSE drug_concept_id END AS drug_concept_id,
    CASE WHEN drug_concept_id % 13 = 5 THEN -days_supply - 3 ELSE days_supply END AS days_supply,
    CASE WHEN drug_concept_id % 13 = 6 THEN NULL ELSE drug_type_concept_id END AS drug_type_concept_id,
    CASE WHEN drug_concept_id % 13 = 7 THEN drug_exposure_start_date - 4 ELSE drug_exposure_end_date END AS drug_exposure_end_date,
    CASE WHEN drug_concept_id % 13 = 8 THEN NULL ELSE dose_unit_concept_id END AS dose_unit_concept_id)
  FROM de_once),
ca AS (""")
_CLAMPED = _DIRTY.replace("norm_end,\n         CASE WHEN drug_exposure_end_date IS NOT NULL", "raw_end,\n         CASE WHEN drug_exposure_end_date IS NOT NULL").replace(
    "\nden AS (", "\nden_raw AS (").replace("\ndt AS (", "\nden AS (SELECT *, GREATEST(raw_end, drug_exposure_start_date) AS norm_end FROM den_raw),\ndt AS (")
_VALID = "ctv AS (SELECT * FROM ct WHERE s IS NOT NULL AND e >= s)"
_VALID_CLAMPED = "ctv AS (SELECT * REPLACE (GREATEST(e, s) AS e) FROM ct WHERE s IS NOT NULL)"


def _reason(keys: list[str], start: str, end: str) -> str:
    nulls = "".join(f" WHEN {c} IS NULL THEN '{name}'" for c, name in [(start, "null_start_date"), (end, "null_end_date"), *[(k, f"null_{k}") for k in keys]])
    return f"CASE{nulls} WHEN {end} < {start} THEN 'end_before_start' END"


def _stored_and_dirty_oracles(q: dict[str, str]) -> dict[str, str]:
    """Queries on stored tables and on dirty sources, from the plain ones in ``q``."""
    out = {
        "attach_stored_eras": q["assign_era_end"],
        "condition_era_appended_twice": q["condition_era"],
        "drug_era_from_files": q["drug_era_covered"],
    }
    audit = """
, x AS (SELECT {keys}, COUNT(*) AS n FROM (SELECT DISTINCT {keys}, {record} FROM {src}) GROUP BY ALL),
  r AS (SELECT {keys}, SUM(n) AS n FROM (SELECT {keys}, era_end, COUNT(*) AS n FROM (SELECT DISTINCT {keys}, era_end, {record} FROM {rows}) GROUP BY ALL) GROUP BY {keys})
SELECT (SELECT COUNT(*) FROM x) AS expected_n_keys, (SELECT COUNT(*) FROM r) AS stored_n_keys,
       (SELECT CAST(SUM(n) AS BIGINT) FROM x) AS expected_records, (SELECT CAST(SUM(n) AS BIGINT) FROM r) AS stored_records,
       NOT EXISTS (SELECT 1 FROM x FULL JOIN r USING ({keys}) WHERE x.n IS DISTINCT FROM r.n) AS matches"""
    drug, cond = ", ".join(DRUG_KEYS), ", ".join(COND_KEYS)
    out["stored_drug_era_audit"] = _with(_REPEATED, _DRUG_SWEEP) + audit.format(keys=drug, record="drug_exposure_id, s, e", src="dt", rows="g_rows")
    out["stored_condition_era_audit"] = _with(_REPEATED, _COND_SWEEP) + audit.format(keys=cond, record="condition_occurrence_id, s", src="ct", rows="c_rows")
    out["stored_drug_era_faults"] = _with(_REPEATED, _DRUG_SWEEP) + f"""
SELECT {drug}, COUNT(*) AS expected_count, COUNT(*) - COUNT(DISTINCT era_end) AS stored_count
FROM (SELECT DISTINCT {drug}, era_end, drug_exposure_id, s, e FROM g_rows)
WHERE person_id % {LOST_MOD} = 0 GROUP BY {drug}"""
    drug_reason = _reason(["person_id", "drug_concept_id"], "drug_exposure_start_date", "norm_end")
    out["drug_quarantine"] = _with(_DIRTY) + f"""
SELECT drug_exposure_id, person_id, drug_concept_id, drug_exposure_start_date, norm_end AS drug_exposure_end_date, {drug_reason} AS reason
FROM den WHERE {drug_reason} IS NOT NULL"""
    cond_reason = _reason(COND_KEYS, "s", "e")
    out["condition_quarantine"] = _with(_DIRTY) + f"""
SELECT condition_occurrence_id, {cond}, s AS condition_start_date, e AS condition_end_date, {cond_reason} AS reason
FROM ct WHERE {cond_reason} IS NOT NULL"""
    for name in ("drug_era_by_type", "dose_era"):
        out[f"dirty_{name}"] = q[name].replace(_SOURCES.strip("\n"), _DIRTY.strip("\n"))
    out["dirty_drug_era_clamped"] = q["drug_era_covered"].replace(_SOURCES.strip("\n"), _CLAMPED.strip("\n"))
    for name in ("drug_quality_report", "dose_quality_report"):
        out[f"dirty_{name}"] = q[name].replace(_SOURCES.strip("\n"), _DIRTY.strip("\n"))
    out["dirty_condition_quality_report"] = q["condition_quality_report"].replace(_SOURCES.strip("\n"), _DIRTY.strip("\n")).replace(UNMAPPED_CONDITION, "0")
    out["dirty_nonneg_supply"] = q["drug_exposure_nonneg_supply"].replace(_SOURCES.strip("\n"), _DIRTY.strip("\n"))
    sweep = _sweep("ctv", COND_KEYS, 30, "c")
    by_type, plain = (q[n][q[n].rindex("SELECT person_id, condition_concept_id"):] for n in ("condition_era_by_type", "condition_era"))
    out["dirty_condition_era_by_type"] = _with(_DIRTY, _VALID, sweep) + by_type
    out["dirty_condition_era_clamped"] = _with(_DIRTY, _VALID_CLAMPED, sweep) + plain
    return out


def _repeated_oracles() -> dict[str, str]:
    """Counts by id, as the scripts group: an id counts once for its keys and
    start, stockpile eras once more for each different length."""
    q: dict[str, str] = {}
    one = "COUNT(DISTINCT concat_ws('|', {0}, CAST(s AS VARCHAR)))"
    q["condition_era_repeated_ids"] = _with(_REPEATED, _COND_SWEEP) + f"""
SELECT person_id, condition_concept_id,
       MIN(s) AS condition_era_start_date, era_end AS condition_era_end_date,
       {one.format("condition_occurrence_id")} AS condition_occurrence_count
FROM c_rows GROUP BY person_id, condition_concept_id, era_end"""
    q["condition_era_by_type_repeated_ids"] = _with(_REPEATED, _COND_SWEEP) + f"""
SELECT person_id, condition_concept_id,
       MIN(s) AS condition_era_start_date, era_end AS condition_era_end_date,
       condition_type_concept_id, {one.format("condition_occurrence_id")} AS condition_occurrence_count
FROM c_rows GROUP BY person_id, condition_concept_id, condition_type_concept_id, era_end"""
    q["drug_era_stockpile_repeated_ids"] = _with(_REPEATED, _DRUG_SWEEP) + """
, g_once AS (SELECT DISTINCT person_id, ingredient_concept_id, era_end, drug_exposure_id, s, e FROM g_rows)
SELECT person_id, ingredient_concept_id AS drug_concept_id,
       MIN(s) AS drug_era_start_date, era_end AS drug_era_end_date,
       COUNT(*) AS drug_exposure_count, CAST((era_end - MIN(s)) - SUM(e - s) AS BIGINT) AS gap_days
FROM g_once GROUP BY person_id, ingredient_concept_id, era_end"""
    q["drug_era_covered_repeated_ids"] = _with(_REPEATED, _DRUG_SWEEP, _covered("g_rows", DRUG_KEYS, "g")) + f"""
, g_era AS (
  SELECT person_id, ingredient_concept_id, era_end, MIN(s) AS era_start, {one.format("drug_exposure_id")} AS n
  FROM g_rows GROUP BY person_id, ingredient_concept_id, era_end)
SELECT a.person_id, a.ingredient_concept_id AS drug_concept_id,
       a.era_start AS drug_era_start_date, a.era_end AS drug_era_end_date, a.n AS drug_exposure_count,
       CAST((a.era_end - a.era_start) - COALESCE(c.covered, 0) AS BIGINT) AS gap_days
FROM g_era a LEFT JOIN g_cov c
  ON a.person_id = c.person_id AND a.ingredient_concept_id = c.ingredient_concept_id
 AND a.era_end = c.era_end"""
    q["drug_era_by_type_repeated_ids"] = _with(_REPEATED, _DRUG_SWEEP) + f"""
SELECT person_id, ingredient_concept_id AS drug_concept_id,
       MIN(s) AS drug_era_start_date, era_end AS drug_era_end_date,
       drug_type_concept_id, {one.format("drug_exposure_id")} AS drug_exposure_count
FROM g_rows GROUP BY person_id, ingredient_concept_id, drug_type_concept_id, era_end"""
    filtered = _SOURCES.replace("FROM de),", "FROM de WHERE drug_concept_id <> 1 AND days_supply >= 0),")
    q["drug_era_filtered"] = _with(filtered, _DRUG_SWEEP, _covered("g_rows", DRUG_KEYS, "g")) + """
, g_era AS (
  SELECT person_id, ingredient_concept_id, era_end, MIN(s) AS era_start, COUNT(*) AS n
  FROM g_rows GROUP BY person_id, ingredient_concept_id, era_end)
SELECT a.person_id, a.ingredient_concept_id AS drug_concept_id,
       a.era_start AS drug_era_start_date, a.era_end AS drug_era_end_date, a.n AS drug_exposure_count,
       CAST((a.era_end - a.era_start) - COALESCE(c.covered, 0) AS BIGINT) AS gap_days
FROM g_era a LEFT JOIN g_cov c
  ON a.person_id = c.person_id AND a.ingredient_concept_id = c.ingredient_concept_id
 AND a.era_end = c.era_end"""
    fine = _SOURCES.replace(
        "CASE WHEN l_discount = 0 THEN NULL\n              ELSE CAST(ceil(l_quantity / 25) AS DECIMAL(18,2)) END AS effective_drug_dose",
        "CAST(0.0125 + (l_linenumber % 3) * 0.0003 AS DECIMAL(18,4)) AS effective_drug_dose",
    )
    q["dose_era_fine_doses"] = _with(fine, _sweep("dt", _DOSE_KEYS, 30, "x")) + """
SELECT person_id, ingredient_concept_id AS drug_concept_id, unit_concept_id, CAST(dose_value AS DOUBLE) AS dose_value,
       MIN(s) AS dose_era_start_date, era_end AS dose_era_end_date
FROM x_rows GROUP BY person_id, ingredient_concept_id, unit_concept_id, dose_value, era_end"""
    return q


def _drug_eras_sql(sources: str) -> str:
    """Drug eras of the given source CTEs, with ``{gaps}`` for the gap columns."""
    return _with(sources, _DRUG_SWEEP, _covered("g_rows", DRUG_KEYS, "g")) + """
, g_era AS (
  SELECT person_id, ingredient_concept_id, era_end, MIN(s) AS era_start,
         COUNT(*) AS n, SUM(e - s) AS sum_days
  FROM g_rows GROUP BY person_id, ingredient_concept_id, era_end)
SELECT a.person_id, a.ingredient_concept_id AS drug_concept_id,
       a.era_start AS drug_era_start_date, a.era_end AS drug_era_end_date,
       a.n AS drug_exposure_count, {gaps}
FROM g_era a LEFT JOIN g_cov c
  ON a.person_id = c.person_id AND a.ingredient_concept_id = c.ingredient_concept_id
 AND a.era_end = c.era_end"""


def _dose_eras_sql(sources: str) -> str:
    return _with(sources, _sweep("dt", _DOSE_KEYS, 30, "x")) + """
SELECT person_id, ingredient_concept_id AS drug_concept_id, unit_concept_id, dose_value,
       MIN(s) AS dose_era_start_date, era_end AS dose_era_end_date
FROM x_rows GROUP BY person_id, ingredient_concept_id, unit_concept_id, dose_value, era_end"""


def _rollup_sql(sources: str) -> str:
    return _with(sources) + """
SELECT drug_exposure_id, person_id, ingredient_concept_id,
       s AS drug_exposure_start_date, e AS drug_exposure_end_date
FROM dt"""


def _oracles() -> dict[str, str]:
    q = _repeated_oracles()
    q["condition_era"] = _with(_SOURCES, _COND_SWEEP) + """
SELECT person_id, condition_concept_id,
       MIN(s) AS condition_era_start_date, era_end AS condition_era_end_date,
       COUNT(*) AS condition_occurrence_count
FROM c_rows GROUP BY person_id, condition_concept_id, era_end"""
    q["condition_era_by_type"] = _with(_SOURCES, _COND_SWEEP) + """
SELECT person_id, condition_concept_id,
       MIN(s) AS condition_era_start_date, era_end AS condition_era_end_date,
       condition_type_concept_id, COUNT(*) AS condition_occurrence_count
FROM c_rows GROUP BY person_id, condition_concept_id, condition_type_concept_id, era_end"""
    drug_eras = _drug_eras_sql(_SOURCES)
    stock = "CAST((a.era_end - a.era_start) - a.sum_days AS BIGINT)"
    cover = "CAST((a.era_end - a.era_start) - COALESCE(c.covered, 0) AS BIGINT)"
    q["drug_era_stockpile"] = drug_eras.format(gaps=f"{stock} AS gap_days")
    q["drug_era_covered"] = drug_eras.format(gaps=f"{cover} AS gap_days")
    q["drug_era_both_gaps"] = drug_eras.format(
        gaps=f"a.n AS drug_exposure_count_stockpile, {stock} AS gap_days_stockpile, {cover} AS gap_days_covered"
    )
    hot = _SOURCES.replace(
        "l_partkey AS drug_concept_id", "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS drug_concept_id")
    q["drug_era_hot_concept"] = _drug_eras_sql(hot).format(
        gaps=f"a.n AS drug_exposure_count_stockpile, {stock} AS gap_days_stockpile, {cover} AS gap_days_covered"
    )
    q["dose_era_hot_concept"] = _dose_eras_sql(hot)
    q["ingredient_rollup_hot_concept"] = _rollup_sql(hot)
    q["drug_era_by_type"] = _with(_SOURCES, _DRUG_SWEEP) + """
SELECT person_id, ingredient_concept_id AS drug_concept_id,
       MIN(s) AS drug_era_start_date, era_end AS drug_era_end_date,
       drug_type_concept_id, COUNT(*) AS drug_exposure_count
FROM g_rows GROUP BY person_id, ingredient_concept_id, drug_type_concept_id, era_end"""
    q["dose_era"] = _dose_eras_sql(_SOURCES)
    q["drug_end_normalized"] = _with(_SOURCES) + """
SELECT drug_exposure_id, drug_exposure_start_date, norm_end AS drug_exposure_end_date, end_source
FROM den"""
    q["condition_end_normalized"] = _with(_SOURCES) + """
SELECT condition_occurrence_id, s AS condition_start_date, e AS condition_end_date FROM ct"""
    q["ingredient_rollup"] = _rollup_sql(_SOURCES)
    mapped_sweep = _sweep("ctm", COND_KEYS, 30, "m")
    q["condition_era_mapped_only"] = _with(
        _SOURCES,
        f"ctm AS (SELECT * FROM ct WHERE condition_concept_id IS NULL "
        f"OR condition_concept_id <> '{UNMAPPED_CONDITION}')",
        mapped_sweep,
    ) + """
SELECT person_id, condition_concept_id,
       MIN(s) AS condition_era_start_date, era_end AS condition_era_end_date,
       COUNT(*) AS condition_occurrence_count
FROM m_rows GROUP BY person_id, condition_concept_id, era_end"""
    q["drug_exposure_nonneg_supply"] = _with(_SOURCES) + """
SELECT drug_exposure_id, person_id, days_supply FROM de WHERE days_supply >= 0"""
    q["pack_intervals"] = _with(_SOURCES, _COND_SWEEP) + """
SELECT condition_occurrence_id, person_id, condition_concept_id,
       s AS condition_start_date, e AS condition_end_date,
       DENSE_RANK() OVER (PARTITION BY person_id, condition_concept_id ORDER BY era_end) AS era_seq
FROM c_rows"""
    q["era_end_dates"] = _with(_SOURCES, _DRUG_SWEEP) + """
SELECT person_id, ingredient_concept_id, era_end AS era_end_date FROM g_ends"""
    q["assign_era_end"] = _with(_SOURCES, _DRUG_SWEEP) + """
SELECT drug_exposure_id, person_id, ingredient_concept_id,
       s AS drug_exposure_start_date, era_end AS era_end_date
FROM g_rows"""
    subs = _with(_SOURCES, _sweep("dt", DRUG_KEYS, 0, "z")) + """
SELECT person_id, ingredient_concept_id, MIN(s) AS sub_start, era_end AS sub_end,
       COUNT(*) AS record_count{extra}
FROM z_rows GROUP BY person_id, ingredient_concept_id, era_end"""
    q["merge_overlaps"] = subs.format(extra="")
    q["sub_exposure_days"] = subs.format(extra=", CAST(era_end - MIN(s) AS BIGINT) AS days_exposed")
    cond_gap = _with(_SOURCES, _COND_SWEEP, _covered("c_rows", COND_KEYS, "c")) + """
, c_era AS (
  SELECT person_id, condition_concept_id, era_end, MIN(s) AS era_start, SUM(e - s) AS sum_days
  FROM c_rows GROUP BY person_id, condition_concept_id, era_end)
SELECT a.person_id, a.condition_concept_id,
       a.era_start AS condition_era_start_date, a.era_end AS condition_era_end_date,
       {gap} AS gap_days
FROM c_era a LEFT JOIN c_cov c
  ON a.person_id = c.person_id AND a.condition_concept_id = c.condition_concept_id
 AND a.era_end = c.era_end"""
    q["condition_gap_stockpile"] = cond_gap.format(gap=stock)
    q["condition_gap_covered"] = cond_gap.format(gap=cover)
    q["reconcile_counts"] = _with(_SOURCES, _DRUG_SWEEP) + """
, t AS (SELECT COUNT(*) AS target_rows FROM dt),
  r AS (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS era_count_sum
        FROM (SELECT COUNT(*) AS n FROM g_rows GROUP BY person_id, ingredient_concept_id, era_end))
SELECT target_rows, era_count_sum, target_rows = era_count_sum AS matches FROM t, r"""
    q["drug_quality_report"] = _with(_SOURCES) + """
, f AS (
  SELECT den.*, drug_concept_id IN (SELECT descendant_concept_id FROM ing) AS mapped FROM den)
SELECT reason, row_count FROM (
  SELECT 'null_person_id' AS reason, COUNT(*) FILTER (WHERE person_id IS NULL) AS row_count FROM f
  UNION ALL SELECT 'null_start_date', COUNT(*) FILTER (WHERE drug_exposure_start_date IS NULL) FROM f
  UNION ALL SELECT 'null_concept_id', COUNT(*) FILTER (WHERE drug_concept_id IS NULL) FROM f
  UNION ALL SELECT 'unmapped_concept', COUNT(*) FILTER (WHERE drug_concept_id = 0) FROM f
  UNION ALL SELECT 'no_ingredient', COUNT(*) FILTER (WHERE drug_concept_id IS NOT NULL AND NOT mapped) FROM f
  UNION ALL SELECT 'negative_days_supply', COUNT(*) FILTER (WHERE days_supply < 0) FROM f
  UNION ALL SELECT 'null_supply_with_end_date',
                   COUNT(*) FILTER (WHERE days_supply IS NULL AND drug_exposure_end_date IS NOT NULL) FROM f
  UNION ALL SELECT 'end_before_start', COUNT(*) FILTER (WHERE norm_end < drug_exposure_start_date) FROM f
  UNION ALL SELECT 'null_dose', COUNT(*) FILTER (WHERE effective_drug_dose IS NULL) FROM f
  UNION ALL SELECT 'null_dose_unit', COUNT(*) FILTER (WHERE dose_unit_concept_id IS NULL) FROM f)"""
    q["condition_quality_report"] = _with(_SOURCES) + f"""
SELECT reason, row_count FROM (
  SELECT 'null_person_id' AS reason, COUNT(*) FILTER (WHERE person_id IS NULL) AS row_count FROM ct
  UNION ALL SELECT 'null_start_date', COUNT(*) FILTER (WHERE s IS NULL) FROM ct
  UNION ALL SELECT 'null_concept_id', COUNT(*) FILTER (WHERE condition_concept_id IS NULL) FROM ct
  UNION ALL SELECT 'unmapped_concept',
                   COUNT(*) FILTER (WHERE condition_concept_id = '{UNMAPPED_CONDITION}') FROM ct
  UNION ALL SELECT 'end_before_start', COUNT(*) FILTER (WHERE e < s) FROM ct)"""
    q["dose_quality_report"] = _with(_SOURCES) + """
SELECT reason, row_count FROM (
  SELECT 'target_rows' AS reason, COUNT(*) AS row_count FROM dt
  UNION ALL SELECT 'null_dose_value', COUNT(*) FILTER (WHERE dose_value IS NULL) FROM dt
  UNION ALL SELECT 'null_unit', COUNT(*) FILTER (WHERE unit_concept_id IS NULL) FROM dt
  UNION ALL SELECT 'dropped_null_unit_or_dose',
                   COUNT(*) FILTER (WHERE unit_concept_id IS NULL OR dose_value IS NULL) FROM dt)"""
    q["drug_exposure_duplicate_ids"] = _with(_SOURCES) + """
, per AS (SELECT drug_exposure_id, COUNT(*) AS n FROM de GROUP BY drug_exposure_id HAVING COUNT(*) > 1)
SELECT COUNT(*) AS duplicate_ids, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows FROM per"""
    q["event_era_grace2"] = _with(
        """ev AS (SELECT user_id, event_type, CAST(ts AS DATE) AS s, CAST(ts AS DATE) + 1 AS e
                  FROM events)""",
        _sweep("ev", ["user_id", "event_type"], EVENT_GRACE_DAYS, "v"),
    ) + """
SELECT user_id, event_type, MIN(s) AS era_start_date, era_end AS era_end_date,
       COUNT(*) AS event_count
FROM v_rows GROUP BY user_id, event_type, era_end"""
    return q | _stored_and_dirty_oracles(q)


def oracle_sql() -> dict[str, str]:
    sql = _oracles()
    if _LLM:
        sql |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
