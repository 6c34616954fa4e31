"""S1-S6: reading sources with explicit schemas, from files and the catalog."""

from __future__ import annotations

import os

import pytest

from spanpack import EraConfig, TableNames, condition_era, drug_era
from spanpack.plans import build_era_tables, publish_era_tables
from spanpack.schemas import SchemaError, conform, CONDITION_OCCURRENCE
from spanpack.sources import load_sources, read_era_table, read_source
from test_micro import conditions, drugs, vocab


def _write_sources(spark, base):
    co = conditions(spark, [(1, 7, 0, 10, 1), (1, 7, 20, 40, 2), (2, 7, 0, None, 1)])
    de = drugs(spark, [(1, 500, 0, 10, None, 1, 5, "5"), (1, 100, 5, None, 9, 1, 5, "5")])
    ca, c = vocab(spark)
    paths = {}
    for name, df in [("condition_occurrence", co), ("drug_exposure", de), ("concept_ancestor", ca), ("concept", c)]:
        paths[name] = os.path.join(base, name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths, co, de, ca, c


def test_load_sources_from_files_with_explicit_schema(spark, tmp_out):
    paths, co, de, ca, c = _write_sources(spark, tmp_out)
    src = load_sources(spark, paths=paths)
    assert set(src) == {"drug_exposure", "condition_occurrence", "concept_ancestor", "concept"}
    assert sorted(map(tuple, condition_era(src["condition_occurrence"]).collect())) == sorted(
        map(tuple, condition_era(co).collect()))
    assert sorted(map(tuple, drug_era(src["drug_exposure"], src["concept_ancestor"], src["concept"]).collect())) == \
        sorted(map(tuple, drug_era(de, ca, c).collect()))


def test_catalog_tables_job_and_era_table_scan(spark, tmp_out):
    paths, *_ = _write_sources(spark, tmp_out)
    db = "spanpack_test_cdm"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_out, 'wh')}'")
    for name, p in paths.items():
        spark.read.parquet(p).write.mode("overwrite").saveAsTable(f"{db}.{name}")
    tables = TableNames(cdm_schema=db)
    eras = build_era_tables(load_sources(spark, tables), EraConfig(tables=tables), ["condition_era", "drug_era"])
    publish_era_tables(eras, tables)
    publish_era_tables(eras, tables)  # idempotent
    assert read_era_table(spark, "condition_era", tables).count() == eras["condition_era"].count() == 2
    assert read_era_table(spark, "drug_era", tables).count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_schema_validation(spark):
    df = spark.createDataFrame([(1, 2)], "person_id long, x long")
    with pytest.raises(SchemaError):
        conform(df, CONDITION_OCCURRENCE, "condition_occurrence")
    with pytest.raises(KeyError):
        read_source(spark, "nope")
    with pytest.raises(ValueError):
        EraConfig(invalid="keep")
    assert TableNames(cdm_schema="a", vocabulary_schema="v").qualified("concept") == "v.concept"
    assert TableNames(cdm_schema="a").qualified("drug_era") == "a.drug_era"


def test_timestamps_are_cast_to_dates(spark):
    df = spark.createDataFrame(
        [(1, 1, 7, 1, "2020-01-01 10:00:00", None)],
        "condition_occurrence_id long, person_id long, condition_concept_id long, "
        "condition_type_concept_id long, condition_start_date string, condition_end_date string",
    ).selectExpr("condition_occurrence_id", "person_id", "condition_concept_id", "condition_type_concept_id",
                 "CAST(condition_start_date AS TIMESTAMP_NTZ) AS condition_start_date",
                 "CAST(condition_end_date AS TIMESTAMP_NTZ) AS condition_end_date")
    out = conform(df, CONDITION_OCCURRENCE, "co")
    assert dict(out.dtypes)["condition_start_date"] == "date"
    r = condition_era(out).first()
    assert (str(r.condition_era_start_date), str(r.condition_era_end_date)) == ("2020-01-01", "2020-01-02")


def test_command_line_job(spark, tmp_out):
    from spanpack.__main__ import main

    paths, *_ = _write_sources(spark, tmp_out)
    db = "spanpack_cli_cdm"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_out, 'cli_wh')}'")
    for name, p in paths.items():
        spark.read.parquet(p).write.mode("overwrite").saveAsTable(f"{db}.{name}")
    main(["--cdm-schema", db, "--outputs", "condition_era,drug_era,dose_era", "--gap", "both"])
    assert spark.table(f"{db}.condition_era").count() == 2
    assert set(spark.table(f"{db}.drug_era").columns) >= {"gap_days_stockpile", "gap_days_covered"}
    assert spark.table(f"{db}.dose_era").count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_text_vocabulary_and_concept_class_id(spark, tmp_out):
    """Vocabularies that use text ids and ``concept_class_id``: configure, don't edit code."""
    from pyspark.sql import functions as F

    paths, co, de, ca, c = _write_sources(spark, tmp_out)
    c2 = c.select(
        "concept_id",
        F.when(F.col("vocabulary_id") == 8, "RxNorm").alias("vocabulary_id"),
        F.col("concept_class").alias("concept_class_id"),
    )
    p = os.path.join(tmp_out, "concept_v5")
    c2.write.mode("overwrite").parquet(p)
    cfg = EraConfig(vocabulary_value="RxNorm", class_column="concept_class_id")
    src = load_sources(spark, paths={**paths, "concept": p}, cfg=cfg)
    got = drug_era(src["drug_exposure"], src["concept_ancestor"], src["concept"], cfg)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, drug_era(de, ca, c).collect()))
