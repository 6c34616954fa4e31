"""Scans of the clinical source tables (S1-S6).

Inputs come either from the catalog (``spark.table`` with the configured
schema names, the scripts' ``<schema>`` placeholders) or from files read with
an explicit schema. Either way :func:`spanpack.schemas.conform` checks the
columns and casts dates once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spanpack.config import EraConfig, TableNames
from spanpack.schemas import SOURCE_SCHEMAS, concept_schema, conform
from spanpack.sources.versions import read_version

SOURCES = ("drug_exposure", "condition_occurrence", "concept_ancestor", "concept")


SELF_DESCRIBING = ("parquet", "orc", "avro", "delta")


def source_schema(name: str, cfg: EraConfig = EraConfig()) -> T.StructType:
    """The expected schema of a source; ``concept`` follows the configured
    vocabulary and class columns."""
    if name not in SOURCE_SCHEMAS:
        raise KeyError(f"unknown source {name!r}; expected one of {SOURCES}")
    if name == "concept":
        vtype = T.LongType() if isinstance(cfg.vocabulary_value, int) else T.StringType()
        return concept_schema(cfg.vocabulary_column, cfg.class_column, vtype)
    return SOURCE_SCHEMAS[name]


def read_source(
    spark: SparkSession,
    name: str,
    tables: TableNames | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    cfg: EraConfig = EraConfig(),
) -> DataFrame:
    """One source table by logical name.

    ``path`` reads files of ``fmt`` with ``schema``. By default files that
    carry their schema are read with it, others with the expected one
    (:func:`source_schema`); without ``path`` the catalog table
    ``tables.qualified(name)`` is used (``tables`` defaults to ``cfg.tables``).
    """
    tables = tables or cfg.tables
    expected = source_schema(name, cfg)
    if path is None:
        df = spark.table(tables.qualified(name))
    else:
        reader = spark.read.format(fmt)
        if schema is not None or fmt not in SELF_DESCRIBING:
            reader = reader.schema(schema or expected)
        df = reader.load(path)
    return conform(df, expected, name)


def read_era_table(
    spark: SparkSession, name: str, tables: TableNames = TableNames(), path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """An already published era table (S5, used by the count audit): the
    catalog table, or what :func:`spanpack.sources.publish_version` committed
    under ``path``."""
    return spark.table(tables.qualified(name)) if path is None else read_version(spark, path, fmt)


def load_sources(
    spark: SparkSession,
    tables: TableNames | None = None,
    paths: dict[str, str] | None = None,
    fmt: str = "parquet",
    cfg: EraConfig = EraConfig(),
) -> dict[str, DataFrame]:
    """All four sources, from ``paths`` where given, else from the catalog."""
    paths = paths or {}
    return {n: read_source(spark, n, tables, paths.get(n), fmt, cfg=cfg) for n in SOURCES}
