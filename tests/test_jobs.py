"""Whole-job builds share one target and equal the single-output builders."""

from __future__ import annotations

import os

from conftest import SF0001
from spanpack import EraConfig, condition_era, dose_era, drug_era, drug_era_by_type, drug_target
from spanpack.operators.quality import duplicate_id_report
from spanpack.plans import ERA_OUTPUTS, build_era_tables, publish_era_tables
from spanpack.plans.inspect import scan_details
from spanpack.sources import fixtures as fx, read_version


def _sources(spark):
    de, ca, c = fx.drug_sources(spark, SF0001)
    return {"condition_occurrence": fx.condition_occurrence(spark, SF0001),
            "drug_exposure": de, "concept_ancestor": ca, "concept": c}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_job_outputs_equal_single_builders(spark):
    srcs = _sources(spark)
    eras = build_era_tables(srcs, gap="both")
    drug = (srcs["drug_exposure"], srcs["concept_ancestor"], srcs["concept"])
    assert rows(eras["condition_era"]) == rows(condition_era(srcs["condition_occurrence"]))
    assert rows(eras["drug_era"]) == rows(drug_era(*drug, gap="both"))
    assert rows(eras["drug_era_by_type"]) == rows(drug_era_by_type(*drug))
    assert rows(eras["dose_era"]) == rows(dose_era(*drug))
    assert eras["condition_era_by_type"].count() == 1479


def test_shuffle_rollup_materializes_target_once(spark, tmp_out):
    srcs = _sources(spark)
    eras = build_era_tables(srcs, outputs=["drug_era", "dose_era"], materialize="checkpoint")
    assert eras["drug_era"].count() == 6033 and eras["dose_era"].count() == 6516
    publish_era_tables(eras, paths={k: os.path.join(tmp_out, k) for k in eras})
    assert read_version(spark, os.path.join(tmp_out, "dose_era")).count() == 6516


def test_repeated_ids_and_duplicate_report(spark):
    srcs = _sources(spark)
    de = srcs["drug_exposure"]
    doubled = de.unionByName(de.limit(100))
    rep = duplicate_id_report(doubled, ["drug_exposure_id"]).first()
    assert (rep.duplicate_ids, rep.surplus_rows) == (100, 100)
    vocabulary = srcs["concept_ancestor"], srcs["concept"]
    assert drug_target(doubled, *vocabulary).count() > drug_target(de, *vocabulary).count() == 7122
    assert rows(drug_era(doubled, *vocabulary, gap="both")) == rows(drug_era(de, *vocabulary, gap="both"))


def test_never_writes_nothing(spark):
    import os

    def files():
        return sum(len(f) for _, _, f in os.walk(spark.sparkContext.getCheckpointDir().removeprefix("file:")))

    before = files()
    eras = build_era_tables(_sources(spark), outputs=list(ERA_OUTPUTS), materialize="never")
    assert sum(df.count() for df in eras.values()) and files() == before


def test_a_failed_write_leaves_the_previous_eras(spark, tmp_out):
    import pytest
    from pyspark.sql import functions as F

    from spanpack.config import TableNames

    db = "spanpack_staged_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_out, 'staged')}'")
    tables = TableNames(cdm_schema=db)
    eras = {"condition_era": condition_era(_sources(spark)["condition_occurrence"])}
    publish_era_tables(eras, tables)
    kept = spark.table(f"{db}.condition_era").count()
    broken = {"condition_era": eras["condition_era"].withColumn("x", F.raise_error(F.lit("no")).cast("string"))}
    with pytest.raises(Exception):
        publish_era_tables(broken, tables)
    assert spark.table(f"{db}.condition_era").count() == kept > 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_materialize_checkpoint_uses_the_session_folder(spark):
    srcs = _sources(spark)
    eras = build_era_tables(srcs, outputs=["drug_era", "drug_era_by_type"], materialize="checkpoint")
    assert eras["drug_era"].count() == 6033 and eras["drug_era_by_type"].count() == 6700


def test_publish_refuses_two_outputs_for_one_table(spark):
    import pytest

    srcs = _sources(spark)
    eras = build_era_tables(srcs, outputs=["condition_era", "condition_era_by_type"])
    with pytest.raises(ValueError):
        publish_era_tables(eras)


def test_shared_map_is_read_from_the_checkpoint(spark):
    from spanpack.plans.inspect import scan_details

    srcs = _sources(spark)
    eras = build_era_tables(srcs, outputs=["drug_era", "dose_era"])
    for name in ("drug_era", "dose_era"):
        locations = " ".join(s["Location"] for s in scan_details(eras[name]))
        assert "part.parquet" not in locations and "lineitem.parquet" in locations
    assert eras["drug_era"].count() == 6033 and eras["dose_era"].count() == 6516


def test_plain_and_typed_outputs_share_one_numbering(spark):
    from spanpack import condition_era_by_type

    srcs = _sources(spark)
    drug = (srcs["drug_exposure"], srcs["concept_ancestor"], srcs["concept"])
    eras = build_era_tables(srcs, EraConfig(assume_unique_ids=True), outputs=list(ERA_OUTPUTS), gap="both")
    assert rows(eras["condition_era"]) == rows(condition_era(srcs["condition_occurrence"]))
    assert rows(eras["condition_era_by_type"]) == rows(condition_era_by_type(srcs["condition_occurrence"]))
    assert rows(eras["drug_era"]) == rows(drug_era(*drug, gap="both"))
    assert rows(eras["drug_era_by_type"]) == rows(drug_era_by_type(*drug))
    for name in ("condition_era", "drug_era"):  # read from the written numbering, not from source files
        assert all("orders.parquet" not in s["Location"] and "lineitem.parquet" not in s["Location"]
                   for s in scan_details(eras[name]))
