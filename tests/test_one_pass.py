"""Work that is done once: records by id, repeated exposures, audited counts."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import SF0001
from spanpack import summarize_eras
from spanpack.operators import packing
from spanpack.operators.quality import differing_keys, record_counts
from spanpack.plans.inspect import join_count, plan_text, scan_details
from spanpack.sources import fixtures as fx

LENGTHS = [0, 1, 30, 31, 32, 62, 63, 64, 65, 127, 128, 4000]


def _records(spark, lengths):
    """Ids 0 to 4 with one start and different ends, copies among them, under two types."""
    rows = [(1, i % 5, n, "ab"[i % 2]) for i, n in enumerate(lengths * 3)]
    df = spark.createDataFrame(rows, "k int, id int, n int, t string").withColumn("s", F.lit("2020-01-01").cast("date"))
    return rows, df.withColumn("e", F.date_add("s", F.col("n")))


def test_intervals_of_every_length(spark):
    rows, df = _records(spark, LENGTHS)
    want = {(i, n) for _, i, n, _ in rows}
    types = defaultdict(set)
    for _, i, _, t in rows:
        types[t].add(i)
    for measures in (("ids",), ("intervals",), ("ids", "intervals")):
        r = summarize_eras(df, ["k"], "s", "e", id_col="id", measures=measures).first()
        assert r["record_count"] == (5 if "ids" in measures else 0)
        assert r["interval_count"] == (len(want) if "intervals" in measures else 0)
        assert r["sum_days"] == (sum(n for _, n in want) if "intervals" in measures else 0)
        assert str(r["era_end"]) == "2030-12-14"
    both = packing.numbered_day_rows(df, ["k"], "s", "e", split="t", id_col="id", plain=True)
    r = packing.collapse_eras(both, ["k"], "s").first()
    assert (r["record_count"], r["interval_count"], r["sum_days"]) == (5, len(want), sum(n for _, n in want))
    assert {r["t"]: r["record_count"] for r in packing.collapse_eras(both, ["k"], "s", "t").collect()} == {t: len(v) for t, v in types.items()}


def test_a_short_record_travels_once(spark):
    grains = [packing._IDS, packing._INTERVALS]
    rows, df = _records(spark, [n for n in LENGTHS if n < packing.LENGTH_BITS])
    assert packing._rows_by_grain(df, ["k"], "s", "e", None, "id", grains).count() == len(rows)
    rows, df = _records(spark, [64, 4000])
    assert packing._rows_by_grain(df, ["k"], "s", "e", None, "id", grains).count() == 2 * len(rows)


def test_repeated_exposures_join_once(spark):
    got = fx.repeated_exposures(spark, SF0001)
    de = fx.drug_exposure(spark, SF0001)
    assert join_count(got) == 1 and len(scan_details(got)) == 2
    kind = F.split("drug_exposure_id", r"\|")[1].cast("int") % 3
    later = de.filter(kind == 2).withColumns({
        "days_supply": F.col("days_supply") + 7, "drug_exposure_end_date": F.date_add("drug_exposure_end_date", 7)})
    other = de.filter(kind == 0).withColumn("drug_type_concept_id", F.lit("Z"))
    want = de.unionByName(de.filter(kind == 1)).unionByName(later).unionByName(other)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_differing_keys_read_their_sources_once(spark):
    co = fx.condition_occurrence(spark, SF0001)
    counts = record_counts(co, ["person_id", "condition_concept_id"], ["person_id", "condition_concept_id", "condition_start_date"])
    stored = counts.withColumn("n", F.col("n") + (F.col("person_id") % 7 == 0).cast("int"))
    assert len(scan_details(differing_keys(counts, stored, ["person_id", "condition_concept_id"]))) == 2
    a = spark.createDataFrame([(None, 3), (1, 3), (2, 4), (4, 0)], "k int, n long")
    b = spark.createDataFrame([(None, 3), (1, 5), (3, 6)], a.schema)
    assert sorted(tuple(r) for r in differing_keys(a, b, ["k"], buckets=1).collect()) == [(1, 3, 5), (2, 4, 0), (3, 0, 6)]


def test_attached_ends_deal_only_what_is_returned(spark):
    import __spark_entry__ as entry

    plan = plan_text(entry._QUERIES["attach_stored_eras"](spark, SF0001))
    salts = re.findall(r"xxhash64\(([^)]*)\)", plan)
    assert salts and all("drug_exposure_id" in s and "days_supply" not in s and "end_date" not in s for s in salts)
