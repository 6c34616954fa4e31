"""Joins of records with heavy keys to a lookup table."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from conftest import SF0001
from spanpack import EraConfig, drug_target
from spanpack.operators import heavy_keys, spread_join
from spanpack.plans.inspect import plan_text
from spanpack.sources import fixtures as fx


def _records(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, `odd.name` string, more map<string,int>")


LOOKUP = [("a", 1), ("a", 2), ("b", 3), ("z", 4), (None, 5)]


def _plain(rows):
    return Counter((i, k, to) for i, k, *_ in rows for code, to in LOOKUP if k is not None and code == k)


def _spread(spark, rows, parts):
    lookup = spark.createDataFrame(LOOKUP, "code string, to int")
    out = spread_join(_records(spark, rows).repartition(3), lookup, "k", "code", parts)
    assert out.columns == ["id", "k", "odd.name", "more", "code", "to"]
    return Counter((r["id"], r["k"], r["to"]) for r in out.collect())


def test_same_rows_as_a_plain_join(spark):
    rows = [(i, "a", None, {"x": 1}) for i in range(200)]                 # heavy, fans out
    rows += [(-1, "a", "copy", None)] * 50                                # copies of one record
    rows += [(1000 + i, f"c{i}", None, None) for i in range(300)]         # no lookup row
    rows += [(2000 + i, "b", "", None) for i in range(3)] + [(3000, None, None, None)] * 40
    for parts in (1, 2, 8, 1024):
        assert _spread(spark, rows, parts) == _plain(rows)


def test_empty_and_keyless_records(spark):
    assert not _spread(spark, [], 8)
    assert not _spread(spark, [(1, None, None, None)] * 5, 8)


def test_heavy_keys_hold_more_than_their_share(spark):
    rows = [(i, k, None, None) for i, k in enumerate("a" * 60 + "b" * 10 + "c" * 11 + "d" * 19)]
    rows += [(i, None, None, None) for i in range(500)]                   # no key, no share
    got = {r[0]: r[1] for r in heavy_keys(_records(spark, rows), "k", 10).collect()}
    assert got == {"a": 6, "c": 2, "d": 2}


def test_rollup_counts_concepts_map_side(spark):
    """Concepts are counted before their exchange, and nothing is a cross product but the one-row total."""
    text = plan_text(drug_target(*fx.drug_sources(spark, SF0001), EraConfig(spread_hot_concepts=True)))
    assert "partial_count" in text and "CartesianProduct" not in text


def test_rollup_with_a_hot_concept_gives_the_same_target(spark):
    sources = fx.hot_exposures(spark, SF0001), *fx.drug_sources(spark, SF0001)[1:]
    plain, spread = drug_target(*sources), drug_target(*sources, EraConfig(spread_hot_concepts=True))
    assert plain.columns == spread.columns
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()
    hot = heavy_keys(sources[0], "drug_concept_id").agg(F.max("_heavy_shares")).first()[0]
    assert hot > 1024 // 4
