"""Build and publish era tables as one Spark job.

    spark-submit -m spanpack --cdm-schema cdm --vocabulary-schema vocab \\
        --outputs condition_era,drug_era,dose_era

(or ``python -m spanpack ...`` where a session can be created locally).
Reads the four source tables from the catalog, builds the requested eras
with :func:`spanpack.plans.build_era_tables` and overwrites the era tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from spanpack.config import EraConfig, TableNames
from spanpack.plans.jobs import ERA_OUTPUTS, build_era_tables, publish_era_tables
from spanpack.sources.tables import load_sources


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="spanpack", description=__doc__.split("\n")[0])
    p.add_argument("--cdm-schema", default=None, help="schema of the clinical and era tables")
    p.add_argument("--vocabulary-schema", default=None, help="schema of concept / concept_ancestor")
    p.add_argument("--outputs", default="condition_era,drug_era,dose_era",
                   help=f"comma-separated subset of {','.join(ERA_OUTPUTS)}")
    p.add_argument("--gap", default="stockpile", choices=["stockpile", "covered", "both"])
    p.add_argument("--grace-days", type=int, default=30)
    p.add_argument("--default-days", type=int, default=1)
    p.add_argument("--exclude-unmapped", action="store_true")
    p.add_argument("--require-nonneg-supply", action="store_true")
    p.add_argument("--spread-hot-concepts", action="store_true",
                   help="deal the exposures of heavy drug concepts out before the ingredient join")
    p.add_argument("--invalid", default="quarantine", choices=["quarantine", "clamp"])
    p.add_argument("--vocabulary-column", default="vocabulary_id")
    p.add_argument("--vocabulary-value", default="8",
                   help="ingredient vocabulary (an integer id, or text such as RxNorm)")
    p.add_argument("--class-column", default="concept_class")
    p.add_argument("--class-value", default="Ingredient")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--format", default="parquet")
    p.add_argument("--materialize", default="auto", choices=["auto", "never", "checkpoint"])
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("spanpack-eras").getOrCreate()
    tables = TableNames(cdm_schema=args.cdm_schema, vocabulary_schema=args.vocabulary_schema)
    cfg = EraConfig(
        grace_days=args.grace_days,
        default_days=args.default_days,
        exclude_unmapped=args.exclude_unmapped,
        require_nonneg_supply=args.require_nonneg_supply,
        spread_hot_concepts=args.spread_hot_concepts,
        invalid=args.invalid,
        vocabulary_column=args.vocabulary_column,
        vocabulary_value=int(args.vocabulary_value) if args.vocabulary_value.isdigit() else args.vocabulary_value,
        class_column=args.class_column,
        class_value=args.class_value,
        tables=tables,
    )
    outputs = [o.strip() for o in args.outputs.split(",") if o.strip()]
    eras = build_era_tables(load_sources(spark, tables, cfg=cfg), cfg, outputs, args.gap, args.materialize)
    publish_era_tables(eras, tables, mode=args.mode, fmt=args.format)


if __name__ == "__main__":
    main()
