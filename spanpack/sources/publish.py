"""Era table sinks (K1 overwrite, K2 append).

``overwrite`` is the default and is idempotent: publishing the same eras
twice leaves one copy. ``append`` adds rows and duplicates eras when a job is
re-run, so it has to be asked for explicitly.

No global sort is done before writing: the era DataFrames are already hash
partitioned by their keys, so ``sort_within`` only orders rows inside each
output file (a layout hint, as the scripts' ORDER BY is).
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanpack.operators.quality import VALID, invalid_reason

MODES = ("overwrite", "append")
VERSION_SEP = "__v"


def _prepare(df: DataFrame, sort_within: Sequence[str] | None) -> DataFrame:
    return df.sortWithinPartitions(*sort_within) if sort_within else df


def publish(
    df: DataFrame,
    table: str | None = None,
    path: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    sort_within: Sequence[str] | None = ("person_id",),
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Write ``df`` to a catalog ``table`` or to files under ``path``.

    Exactly one of ``table`` / ``path`` must be given. ``bucket_by=(n,
    ["person_id"])`` (tables only) writes a bucketed table, so later joins
    with other person-keyed bucketed tables need no shuffle.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table= or path=")
    writer = _prepare(df, sort_within).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        if table is None:
            raise ValueError("bucket_by needs a catalog table")
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols)
        if sort_within:
            writer = writer.sortBy(*sort_within)
    if table is not None:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def ranged(df: DataFrame, by: Sequence[str], files: int) -> DataFrame:
    """``df`` in ``files`` ranges of nearly equal row counts over ``by`` (say
    person, then start), each in order: a layout for reading by person. Spark
    takes the bounds from the rows themselves, so a person with a large share
    of the rows is cut along the later columns."""
    return df.repartitionByRange(files, *by).sortWithinPartitions(*by)


def publish_split(
    df: DataFrame, keys: list[str], start: str, end: str, path: str, mode: str = "errorifexists", fmt: str = "parquet",
    reason: str = "reason",
) -> None:
    """The rows an era builder takes and those it drops, written in one pass:
    one folder for each reason (see :func:`spanpack.operators.quality.quarantine`),
    the clean rows under ``valid``. No row moves between tasks."""
    marked = df.withColumn(reason, F.coalesce(invalid_reason(keys, start, end), F.lit(VALID)))
    marked.write.mode(mode).format(fmt).partitionBy(reason).save(path)


def read_split(spark: SparkSession, path: str, fmt: str = "parquet", reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their reason) of :func:`publish_split`;
    each reads its own folders only."""
    rows = spark.read.format(fmt).load(path)
    return rows.where(F.col(reason) == VALID).drop(reason), rows.where(F.col(reason) != VALID)


def publish_overwrite(df: DataFrame, **kw) -> None:
    """K1: replace the target's contents with ``df``."""
    publish(df, mode="overwrite", **kw)


def publish_append(df: DataFrame, **kw) -> None:
    """K2: add ``df`` to the target (re-running duplicates rows)."""
    publish(df, mode="append", **kw)


def _versions(spark, table: str) -> list[str]:
    db, _, name = table.rpartition(".")
    listed = spark.catalog.listTables(db) if db else spark.catalog.listTables()
    pattern = re.compile(re.escape(name) + re.escape(VERSION_SEP) + r"\d+_[0-9a-f]{8}$")
    found = [t.name for t in listed if pattern.match(t.name) and not t.isTemporary]
    return [f"{db}.{t}" if db else t for t in sorted(found)]


def publish_swap(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    sort_within: Sequence[str] | None = ("person_id",),
) -> str:
    """Overwrite without an empty window: stage, then swap.

    Each call writes a new versioned table ``<table>__v<time>_<id>`` and then
    repoints the view ``<table>`` at it with ``CREATE OR REPLACE VIEW`` (one
    catalog operation), so readers see either the old or the new eras, never
    an empty or half-written table; if the write fails, the old ones stay.
    ``table`` must be free or already such a view. Older versions are kept
    until :func:`drop_old_versions` is called. Returns the new version's name.
    """
    spark = df.sparkSession
    version = f"{table}{VERSION_SEP}{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    _prepare(df, sort_within).write.mode("errorifexists").format(fmt).saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    return version


def drop_old_versions(spark: SparkSession, table: str, keep: int) -> list[str]:
    """Drop all but the newest ``keep`` versions that :func:`publish_swap` wrote
    (1 at least: the one the view reads). Returns the names dropped."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    old = _versions(spark, table)[:-keep]
    for name in old:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return old
