"""Shards of nearly equal size: minimax contiguous partition, in SQL functions.

Rows with equal texts form an atomic group. Groups stand in one fixed order (by
their text's hash); shards are contiguous runs of groups. The smallest shard
capacity that suffices is found by search over capacities, each checked
greedily: a shard takes groups while they fit, then the next one begins. A
check needs only "the last group that ends at or before x", a filtered maximum
over the table of running sizes; several capacities are checked in one pass.
The cuts of the least feasible capacity are then taken.

Running sizes and slots come from sums by hash bucket (a fixed number of
buckets) plus windows within a bucket, so no window holds all rows, and rows of
one group are spread over sub-buckets before they are numbered.

Null texts have size 1, like empty ones, and share their group. An empty table
has no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

#: Fixed numbers of buckets: of the group order, and of a bucket's rows.
BUCKETS, SUB_BUCKETS = 4_096, 16
#: Capacities checked in one pass.
WAYS = 64


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        F.sha2(body, 256).alias("group"),
    )


def _running(parts: DataFrame, keys: list[str], value: str, within: list[str]) -> DataFrame:
    """``value`` summed over all rows of ``parts`` (a small table) before each,
    in the order of ``keys``, apart for each of ``within``."""
    window = Window.partitionBy(*within).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum(value).over(window), F.lit(0)))


def group_ends(rows: DataFrame) -> DataFrame:
    """``(group, bucket, weight, end)``: each group's size and the running size
    up to and with it."""
    groups = rows.groupBy("group").agg(F.sum("size").alias("weight"))
    groups = groups.withColumn("bucket", (F.conv(F.substring("group", 1, 3), 16, 10).cast("int") % BUCKETS))
    groups = durable(groups)
    sums = groups.groupBy("bucket").agg(F.sum("weight").alias("total"))
    before = _running(sums.withColumn("all", F.lit(1)), ["bucket"], "total", ["all"]).select("bucket", "before")     # BUCKETS rows
    inside = Window.partitionBy("bucket").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    within = groups.withColumn("inside", F.sum("weight").over(inside))
    return within.join(F.broadcast(before), "bucket").select("group", "bucket", "weight", (F.col("before") + F.col("inside")).alias("end"))


def _greedy(ends: DataFrame, capacities: list[int], shards: int, total: int) -> dict[int, list[int] | None]:
    """For each capacity the ends of its greedily filled shards, or None if
    ``shards`` of them do not hold everything."""
    cuts: dict[int, list[int]] = {c: [0] for c in capacities}
    for _ in range(shards):
        todo = [c for c in capacities if cuts[c][-1] < total]
        if not todo:
            break
        # the thresholds are rows and not literals, so that every pass runs the same compiled plan
        values = ", ".join(f"({i}, {cuts[c][-1]}L, {cuts[c][-1] + c}L)" for i, c in enumerate(todo))
        limits = ends.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(i, low, high)")
        near = ends.select("end").join(F.broadcast(limits), (F.col("end") > F.col("low")) & (F.col("end") <= F.col("high")))
        got = {r["i"]: r["e"] for r in near.groupBy("i").agg(F.max("end").alias("e")).collect()}      # WAYS + 1 rows
        for i, c in enumerate(todo):
            cuts[c].append(got.get(i, cuts[c][-1]))
    return {c: x if x[-1] == total else None for c, x in cuts.items()}


def best_cuts(ends: DataFrame, shards: int) -> list[int]:
    """Ends of the shards (the last is the total) whose largest is least. The
    heaviest group and an even share bound the capacity from below, their sum
    from above."""
    total, heaviest = ends.agg(F.max("end"), F.max("weight")).first()
    if not total:
        return []
    low = max(heaviest, -(-total // shards))
    high = min(total, -(-total // shards) + heaviest)
    cuts = None
    while low < high or cuts is None:
        step = max(1, -(-(high - low) // WAYS))
        tried = sorted({min(high, low + i * step) for i in range(WAYS + 1)})
        got = _greedy(ends, tried, shards, total)
        best = min(c for c in tried if got[c] is not None)
        cuts, high = got[best], best
        low = max([low, *[c + 1 for c in tried if c < best]])
    return cuts[1:]


def shard(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``. The law is
    ``bytes``: sizes near equal, equal texts together; slots run from 0 without
    gaps in each shard. Rows that repeat id and text get slots of their own."""
    rows = sized(docs, doc_id, text)
    ends = durable(group_ends(rows))
    cuts = best_cuts(ends, shards)
    number = sum((F.when(F.col("end") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0))
    placed = rows.join(ends.select("group", "bucket", number.alias("shard")), "group")
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("doc_id"), F.lit(SUB_BUCKETS)))
    placed = durable(placed.select("doc_id", "size", "text_crc32", "shard", "bucket", "sub"))
    counts = placed.groupBy("shard", "bucket", "sub").agg(F.count("*").alias("n"))
    before = _running(counts, ["bucket", "sub"], "n", ["shard"]).select("shard", "bucket", "sub", "before")   # some 65,000 rows
    inside = Window.partitionBy("shard", "bucket", "sub").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("inside", F.row_number().over(inside)).join(before, ["shard", "bucket", "sub"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
