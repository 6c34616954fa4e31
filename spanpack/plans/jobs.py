"""Whole-job plans: build (and publish) several era tables from one set of sources.

All drug outputs share one drug target (exposure x ingredient with type,
unit and dose carried along) and one ingredient map. With more
than one drug output the map is written once to the shared checkpoint
folder (when the session has one), so the vocabulary is read once.

Plain and by-type variants of one table share one run numbering, written once
to the checkpoint folder, and both outputs aggregate that table. The target is
read once for both: its day rows carry counts at two grains, since an id under
two types counts once in the plain table and once for each type in the other
(``EraConfig.assume_unique_ids`` trusts ids, and one grain serves both).

``materialize``: ``auto`` writes the ingredient map and a shared numbering,
``checkpoint`` the drug target as well, ``never`` nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from spanpack.checkpoint import reliable_checkpoint
from spanpack.config import EraConfig, TableNames
from spanpack.operators.eras import (
    condition_era_by_type_columns,
    condition_era_columns,
    condition_eras_by_type_from_target,
    condition_eras_from_target,
    dose_eras_from_target,
    drug_era_by_type_columns,
    drug_era_columns,
    drug_eras_by_type_from_target,
    drug_eras_from_target,
    gap_measures,
)
from spanpack.operators.packing import collapse_eras, numbered_day_rows
from spanpack.operators.targets import (
    COND_END,
    COND_START,
    CONDITION_KEYS,
    DRUG_END,
    DRUG_KEYS,
    DRUG_START,
    condition_target,
    drug_target,
    ingredient_map,
)
from spanpack.sources.publish import publish, publish_swap
from spanpack.sources.versions import publish_version

ERA_OUTPUTS = ("condition_era", "condition_era_by_type", "drug_era", "drug_era_by_type", "dose_era")
DRUG_OUTPUTS = ("drug_era", "drug_era_by_type", "dose_era")
MATERIALIZE = ("auto", "never", "checkpoint")


def _materialize(target: DataFrame) -> DataFrame:
    written = reliable_checkpoint(target)
    if written is None:
        raise RuntimeError("materialize='checkpoint' needs spark.checkpoint.dir (a shared folder)")
    return written


def build_era_tables(
    sources: dict[str, DataFrame],
    cfg: EraConfig = EraConfig(),
    outputs: Iterable[str] = ERA_OUTPUTS,
    gap: str = "stockpile",
    materialize: str = "auto",
) -> dict[str, DataFrame]:
    """Era DataFrames by output name (see ``ERA_OUTPUTS``).

    ``sources`` holds ``condition_occurrence`` and/or ``drug_exposure``,
    ``concept_ancestor``, ``concept`` (e.g. from
    :func:`spanpack.sources.load_sources`). ``gap`` is passed to the drug era
    (``stockpile``, ``covered`` or ``both``).
    """
    outputs = list(outputs)
    unknown = set(outputs) - set(ERA_OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs {sorted(unknown)}; expected {ERA_OUTPUTS}")
    if materialize not in MATERIALIZE:
        raise ValueError(f"materialize must be one of {MATERIALIZE}")
    out: dict[str, DataFrame] = {}

    def shared_numbering(target, keys, start, end, split, id_col, measures):
        """Plain and by-type outputs from one numbered table, written once
        to the shared checkpoint folder (recomputed per output without one)."""
        numbered = numbered_day_rows(
            target, keys, start, end, cfg.grace_days, split, cfg.id_column(id_col), measures, plain=True
        )
        if materialize != "never":
            numbered = reliable_checkpoint(numbered) or numbered
        return collapse_eras(numbered, keys, start), collapse_eras(numbered, keys, start, split)

    if {"condition_era", "condition_era_by_type"} & set(outputs):
        with_type = "condition_era_by_type" in outputs
        ct = condition_target(sources["condition_occurrence"], cfg, with_type=with_type)
        if with_type and "condition_era" in outputs:
            plain, typed = shared_numbering(
                ct, CONDITION_KEYS, COND_START, COND_END, "condition_type_concept_id", "condition_occurrence_id", ("ids",)
            )
            out["condition_era"] = condition_era_columns(plain)
            out["condition_era_by_type"] = condition_era_by_type_columns(typed)
        else:
            if with_type:
                out["condition_era_by_type"] = condition_eras_by_type_from_target(ct, cfg)
            if "condition_era" in outputs:
                out["condition_era"] = condition_eras_from_target(ct, cfg)

    wanted = [o for o in DRUG_OUTPUTS if o in outputs]
    if wanted:
        # several outputs: write the small map once instead of rebuilding it per job
        mapping = ingredient_map(sources["concept_ancestor"], sources["concept"], cfg)
        if materialize != "never" and len(wanted) > 1:
            mapping = reliable_checkpoint(mapping) or mapping
        extra = []
        if "drug_era_by_type" in wanted:
            extra.append("drug_type_concept_id")
        if "dose_era" in wanted:
            extra += ["dose_unit_concept_id", "effective_drug_dose"]
        dt = drug_target(sources["drug_exposure"], None, None, cfg, extra=extra, mapping=mapping)
        if materialize == "checkpoint":
            dt = _materialize(dt)
        if "drug_era" in wanted and "drug_era_by_type" in wanted:
            plain, typed = shared_numbering(
                dt, DRUG_KEYS, DRUG_START, DRUG_END, "drug_type_concept_id", "drug_exposure_id", gap_measures(gap)
            )
            out["drug_era"] = drug_era_columns(plain, gap)
            out["drug_era_by_type"] = drug_era_by_type_columns(typed)
        else:
            if "drug_era" in wanted:
                out["drug_era"] = drug_eras_from_target(dt, cfg, gap)
            if "drug_era_by_type" in wanted:
                out["drug_era_by_type"] = drug_eras_by_type_from_target(dt, cfg)
        if "dose_era" in wanted:
            dose = dt.withColumnRenamed("dose_unit_concept_id", "unit_concept_id").withColumnRenamed(
                "effective_drug_dose", "dose_value"
            )
            out["dose_era"] = dose_eras_from_target(dose, cfg)
    return {o: out[o] for o in outputs}


DEFAULT_TARGETS = {
    "condition_era": "condition_era",
    "condition_era_by_type": "condition_era",
    "drug_era": "drug_era",
    "drug_era_by_type": "drug_era",
    "dose_era": "dose_era",
}


def publish_era_tables(
    eras: dict[str, DataFrame],
    tables: TableNames = TableNames(),
    targets: dict[str, str] | None = None,
    paths: dict[str, str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    staged: bool = True,
) -> None:
    """Write each era DataFrame to its catalog table (or to ``paths[name]``).

    An overwritten target is staged: a table is swapped in (:func:`publish_swap`),
    a path gets a new version and a commit (:func:`publish_version`, read with
    :func:`read_version`), so a failing write leaves the previous eras
    readable; ``staged=False`` replaces an ordinary table or folder in place.
    An append to a path in that form goes through ``publish_version`` as well.

    ``targets`` maps output name -> logical table name of ``tables``; the
    by-type outputs go to the same logical tables as the plain ones by
    default, so build either the plain or the by-type variant per table.
    """
    targets = {**DEFAULT_TARGETS, **(targets or {})}
    paths = paths or {}
    dest = [paths.get(n) or tables.qualified(targets[n]) for n in eras]
    if len(set(dest)) != len(dest):
        raise ValueError(f"two outputs would overwrite the same table: {dict(zip(eras, dest))}")
    for name, df in eras.items():
        if name in paths and staged:
            publish_version(df, paths[name], mode=mode, fmt=fmt)
        elif name in paths:
            publish(df, path=paths[name], mode=mode, fmt=fmt)
        elif staged and mode == "overwrite":
            publish_swap(df, tables.qualified(targets[name]), fmt=fmt)
        else:
            publish(df, table=tables.qualified(targets[name]), mode=mode, fmt=fmt)
