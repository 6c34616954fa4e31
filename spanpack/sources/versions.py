"""Path targets with a commit log: all-or-nothing overwrite, re-run safe append.

A target folder holds ``data/<version>`` (one folder for each publish) and
``commits`` (one small JSON file for each publish). A publish writes its data
first and adds its commit last, so a failing write leaves readers with what was
there: a version without a commit is not read. Readers take the last overwrite
and the appends after it.

An append may name its ``batch``; a batch that is already part of the target is
not written again, so a re-run job leaves one copy. An overwrite starts anew
and forgets the batches before it.

One writer at a time is assumed. Old versions stay until the storage's owner
removes them. The log is read by Spark and has one row a publish.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

COMMIT = "seq long, action string, version string, batch string"


def commits(spark: SparkSession, path: str) -> list[dict]:
    """The publishes that count, oldest first: the last overwrite and the appends after it."""
    try:
        rows = [r.asDict() for r in spark.read.schema(COMMIT).json(f"{path}/commits").collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    rows = sorted(rows, key=lambda r: (r["seq"], r["version"]))
    last = max((i for i, r in enumerate(rows) if r["action"] == "overwrite"), default=0)
    return rows[last:]


def publish_version(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    batch: str | None = None,
    fmt: str = "parquet",
    sort_within: Sequence[str] | None = ("person_id",),
    compression: str | None = None,
) -> str | None:
    """Write ``df`` as a new version of the target under ``path`` and commit it.
    Returns the version, or None where ``batch`` was there already. ``compression``
    names a codec of ``fmt``; without it Spark's setting holds."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be overwrite or append")
    spark = df.sparkSession
    current = commits(spark, path)
    if mode == "append" and batch is not None and any(c["batch"] == batch for c in current):
        return None
    seq = max((c["seq"] for c in current), default=0) + 1
    version = f"v{seq}-{uuid.uuid4().hex[:8]}"
    rows = df.sortWithinPartitions(*sort_within) if sort_within else df
    options = {"compression": compression} if compression else {}
    rows.write.mode("errorifexists").format(fmt).options(**options).save(f"{path}/data/{version}")
    commit = spark.createDataFrame([(seq, mode, version, batch)], COMMIT).coalesce(1)
    commit.write.mode("append").json(f"{path}/commits")
    return version


def read_version(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """What was published under ``path``."""
    current = commits(spark, path)
    if not current:
        raise FileNotFoundError(f"nothing is published under {path}")
    return spark.read.format(fmt).load([f"{path}/data/{c['version']}" for c in current])
