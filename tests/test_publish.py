"""K1/K2: overwrite is idempotent, append duplicates."""

from __future__ import annotations

import os

import pytest

from conftest import SF0001
from spanpack import condition_era
from spanpack.sources import fixtures as fx
from spanpack.sources import publish, publish_append, publish_overwrite


def test_overwrite_twice_then_append(spark, tmp_out):
    eras = condition_era(fx.condition_occurrence(spark, SF0001))
    path = os.path.join(tmp_out, "condition_era")
    publish_overwrite(eras, path=path)
    publish_overwrite(eras, path=path)
    assert spark.read.parquet(path).count() == 1446
    publish_append(eras, path=path)
    assert spark.read.parquet(path).count() == 2 * 1446
    publish_overwrite(eras, path=path)
    back = spark.read.parquet(path)
    assert back.count() == 1446
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, eras.collect()))


def test_publish_arguments(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        publish(df, mode="merge", path="/tmp/x")
    with pytest.raises(ValueError):
        publish(df)


def test_publish_swap_never_shows_an_empty_table(spark, tmp_out):
    from spanpack.sources import drop_old_versions, publish_swap

    db = "spanpack_swap_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_out, 'wh')}'")
    eras = condition_era(fx.condition_occurrence(spark, SF0001))
    v1 = publish_swap(eras, f"{db}.condition_era")
    assert spark.table(f"{db}.condition_era").count() == 1446
    v2 = publish_swap(eras.limit(10), f"{db}.condition_era")
    assert v1 != v2
    assert spark.table(f"{db}.condition_era").count() == 10
    names = {t.name for t in spark.catalog.listTables(db)}
    assert v2.split(".")[1] in names and v1.split(".")[1] in names  # previous kept
    v3 = publish_swap(eras, f"{db}.condition_era")
    assert drop_old_versions(spark, f"{db}.condition_era", keep=2) == [v1]
    names = {t.name for t in spark.catalog.listTables(db)}
    assert v1.split(".")[1] not in names and {v2.split(".")[1], v3.split(".")[1]} <= names
    assert spark.table(f"{db}.condition_era").count() == 1446
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_bucketed_publish_joins_without_shuffle(spark, tmp_out):
    from spanpack.plans.inspect import shuffle_count

    db = "spanpack_bucket_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(tmp_out, 'bwh')}'")
    eras = condition_era(fx.condition_occurrence(spark, SF0001))
    publish(eras, table=f"{db}.a", bucket_by=(4, ["person_id"]))
    publish(eras, table=f"{db}.b", bucket_by=(4, ["person_id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(f"{db}.a").join(spark.table(f"{db}.b"), "person_id")
        assert shuffle_count(j) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        publish(eras, path=os.path.join(tmp_out, "x"), bucket_by=(4, ["person_id"]))
    spark.sql(f"DROP DATABASE {db} CASCADE")
