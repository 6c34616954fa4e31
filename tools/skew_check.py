"""Skew experiment: a key holding a third of all rows.

Not a registered query (it runs on generated rows by design). It runs
1. ``summarize_eras`` (day-level plan) vs a single-window row-level plan
   with one key holding a third of 3M rows spread over ten years, and
2. ``pack_intervals`` with that key's rows all on ONE day, with AQE skew
   thresholds lowered so the split is visible at this size, and
3. a join to a lookup table on that key, plain and by ``spread_join``, without
   broadcasting or AQE's skew join,
and prints, per shuffle-reading stage, the total and the largest per-task
shuffle input taken from Spark's event log (written to a fresh folder
under the given directory).

    python tools/skew_check.py $(mktemp -d /tmp/run-XXXXXX)
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from spanpack import pack_intervals, summarize_eras  # noqa: E402
from spanpack.operators import spread_join  # noqa: E402
from spanpack.session import local_session  # noqa: E402

ROWS = 3_000_000


def rows(spark, hot_same_day: bool, n: int = ROWS):
    base = spark.range(n, numPartitions=16)
    hot = F.col("id") % 3 == 0
    spread = F.date_add(F.lit("2000-01-01").cast("date"), ((F.col("id") * 7919) % 3650).cast("int"))
    start = F.when(hot, F.lit("2005-05-05").cast("date")).otherwise(spread) if hot_same_day else spread
    return base.select(
        "id",
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 100000 + 1).alias("k"),
        start.alias("s"),
    ).withColumn("e", F.date_add("s", (F.col("id") % 40).cast("int")))


def stage_stats(logdir: str) -> list[dict]:
    path = glob.glob(os.path.join(logdir, "*", "events_*"))[0]
    group, stats = {}, {}
    for line in open(path):
        ev = json.loads(line)
        if ev["Event"] == "SparkListenerJobStart":
            for sid in ev["Stage IDs"]:
                group[sid] = ev.get("Properties", {}).get("spark.jobGroup.id")
        elif ev["Event"] == "SparkListenerTaskEnd":
            read = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            s = stats.setdefault(ev["Stage ID"], {"tasks": 0, "total": 0, "max_task": 0})
            s["tasks"] += 1
            s["total"] += read
            s["max_task"] = max(s["max_task"], read)
    return [
        {"plan": group.get(sid), "stage": sid, **s} for sid, s in sorted(stats.items()) if s["total"] > 1
    ]


def main(scratch: str, n: int = ROWS) -> None:
    logdir = os.path.join(scratch, "eventlog")
    os.makedirs(logdir, exist_ok=True)
    spark = local_session(cores=8, shuffle_partitions=16, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    })
    sc = spark.sparkContext
    df = rows(spark, hot_same_day=False, n=n)
    sc.setJobGroup("day_level_eras", "summarize_eras")
    summarize_eras(df, ["k"], "s", "e", 30).write.format("noop").mode("overwrite").save()
    same_day = rows(spark, hot_same_day=True, n=n).withColumn("id", F.monotonically_increasing_id())
    copies = same_day.withColumn("id", F.when(F.col("k") == 0, F.lit(-1)).otherwise(F.col("id")))
    for name, source in (("default_hot_day", same_day), ("default_hot_copies", copies)):
        for measures in (("ids",), ("intervals",), ("ids", "intervals")):
            sc.setJobGroup(name, "summarize_eras by id")
            eras = summarize_eras(source, ["k"], "s", "e", 30, id_col="id", measures=measures)
            eras.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("row_level_window", "single window over rows")
    w = Window.partitionBy("k").orderBy("s", "e")
    x = df.withColumn("p", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("o", (F.col("p").isNull() | (F.col("s") > F.date_add("p", 30))).cast("int"))
    x = x.withColumn("q", F.sum("o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x.groupBy("k", "q").agg(F.count("*")).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("pack_intervals_hot_day", "row-level join-back, hot (key, day)")
    pack_intervals(rows(spark, hot_same_day=True, n=n), ["k"], "s", "e", 30).write.format("noop").mode(
        "overwrite"
    ).save()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lookup = spark.range(100_001, numPartitions=16).select(F.col("id").alias("code"), (F.col("id") % 97).alias("to"))
    sc.setJobGroup("lookup_plain", "join to a lookup table")
    df.join(lookup, F.col("k") == F.col("code")).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("lookup_spread", "spread_join to a lookup table")
    spread_join(df, lookup, "k", "code").write.format("noop").mode("overwrite").save()
    spark.stop()
    for s in stage_stats(logdir):
        print(json.dumps(s))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else ROWS)
