"""Independent Spark formulations of condition eras, for tests and the bench
comparison only (both put a whole key in one task, so neither is a library
path):

* ``sweep_condition_era``: +1/-1 events with a running open count find era
  ends, then each record takes the earliest era end on or after its start
  through an equi + range join (the counting form).
* ``session_window_condition_era``: ``session_window`` with a per-row gap of
  record length + grace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["person_id", "condition_concept_id"]
S, E = "condition_start_date", "condition_end_date"


def sweep_condition_era(target: DataFrame, grace: int = 30) -> DataFrame:
    t = target.select("condition_occurrence_id", *KEYS, S, E)
    ev = t.select(*KEYS, F.col(S).alias("d"), F.lit(0).alias("kind"), F.lit(1).alias("delta")).unionByName(
        t.select(*KEYS, F.date_add(E, grace).alias("d"), F.lit(1).alias("kind"), F.lit(-1).alias("delta"))
    )
    w = Window.partitionBy(*KEYS).orderBy("d", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        ev.withColumn("n_open", F.sum("delta").over(w))
        .filter((F.col("kind") == 1) & (F.col("n_open") == 0))
        .select(*[F.col(k).alias("x_" + k) for k in KEYS], F.date_sub("d", grace).alias("era_end"))
    )
    cond = (F.col("x_person_id") == F.col("person_id")) & (
        F.col("x_condition_concept_id") == F.col("condition_concept_id")
    ) & (F.col("era_end") >= F.col(S))
    assigned = t.join(ends, cond).groupBy("condition_occurrence_id", *KEYS, S).agg(
        F.min("era_end").alias("era_end")
    )
    return assigned.groupBy(*KEYS, "era_end").agg(
        F.min(S).alias("condition_era_start_date"),
        F.count(F.lit(1)).alias("condition_occurrence_count"),
    ).select(*KEYS, "condition_era_start_date", F.col("era_end").alias("condition_era_end_date"),
             "condition_occurrence_count")


def session_window_condition_era(target: DataFrame, grace: int = 30) -> DataFrame:
    gap = F.concat((F.datediff(E, S) + grace).cast("string"), F.lit(" days"))
    ts = F.col(S).cast("timestamp")
    g = target.groupBy(*KEYS, F.session_window(ts, gap).alias("w")).agg(
        F.min(S).alias("condition_era_start_date"),
        F.count(F.lit(1)).alias("condition_occurrence_count"),
    )
    return g.select(
        *KEYS,
        "condition_era_start_date",
        F.date_sub(F.to_date(F.col("w.end")), grace).alias("condition_era_end_date"),
        "condition_occurrence_count",
    )
