"""SimHash near-duplicates where ids repeat."""

from __future__ import annotations

import collections

import brute
import corpus_pipeline
from .conftest import prose


def test_one_row_of_each_component_though_ids_repeat(spark):
    rows = [(3, prose(1, 80)), (14, prose(1, 80)), (14, prose(2, 80)), (14, prose(2, 80)), (14, prose(3, 80)), (15, prose(3, 80)), (None, prose(4, 80)), (None, prose(5, 80))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert collections.Counter(map(str, kept)) == collections.Counter(map(str, [rows[0], rows[2], rows[4], rows[6], rows[7]]))


def test_edge_rows_by_component(spark, edge_docs):
    fps = [brute.simhash(r["text"]) for r in edge_docs.collect()]
    groups = brute.components(fps, fps)
    kept = [brute.simhash(r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, edge_docs, "").collect()]
    assert sorted(dict(zip(fps, groups))[f] for f in kept) == sorted(set(groups))
