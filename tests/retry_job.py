"""Run eras with injected first-attempt task failures (used by test_retry.py).

A test-only ``mapInPandas`` hook fails the first attempt of partition 0,
once in the scan stage and once after the day-level shuffle; Spark retries
the tasks (``local[4,3]``) and the result must equal the clean run.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from spanpack import condition_target, summarize_eras  # noqa: E402
from spanpack.sources import fixtures as fx  # noqa: E402

KEYS = ["person_id", "condition_concept_id"]


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected failure (first attempt)")
    yield from batches


def main(sf_dir: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]").appName("retry")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
             .getOrCreate())
    spark.sparkContext.setLogLevel("WARN")  # lost-task warnings prove the failures happened
    t = condition_target(fx.condition_occurrence(spark, sf_dir))
    clean = summarize_eras(t, KEYS, "condition_start_date", "condition_end_date", 30)
    # failure in the scan stage
    t1 = t.mapInPandas(flaky, t.schema)
    first = summarize_eras(t1, KEYS, "condition_start_date", "condition_end_date", 30)
    # failure after a shuffle: the input arrives through an exchange
    t2 = t.repartition(4, "person_id").mapInPandas(flaky, t.schema)
    second = summarize_eras(t2, KEYS, "condition_start_date", "condition_end_date", 30)

    def rows(df):
        return sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in df.collect())

    base = rows(clean)
    print(json.dumps({"rows": len(base), "scan_retry_equal": rows(first) == base,
                      "shuffle_retry_equal": rows(second) == base}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
