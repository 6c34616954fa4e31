"""Driver-style run in a plain session with a non-UTC time zone (used by test_session.py)."""

from __future__ import annotations

import json
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from oracle import compare, duck  # noqa: E402

NAMES = ["condition_era", "drug_era_both_gaps", "event_era_grace2", "drug_end_normalized"]


def main(sf_dir: str) -> None:
    spark = (SparkSession.builder.master("local[4]").appName("tz")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "America/Los_Angeles")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    result = {"entry_rows": E.entry(spark).count()}
    for name in NAMES:
        result[name] = compare(spark, name, E.queries()[name], E.oracle_sql()[name], sf_dir, con)[0]
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
