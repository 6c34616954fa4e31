from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that the operators use inside, as extra columns of a caller's table.
CLASHES = ["fp", "score", "shard", "row_key", "_spans", "ids", "crc", "sketch", "u", "size", "_row_key", "text2"]

_W = [f"w{i}x" for i in range(400)]


def prose(seed: int, n: int) -> str:
    return " ".join(_W[(seed * 7919 + i * i * 31 + i * seed * 17) % 400] + "." * (i % 9 == 8) for i in range(n))


def edge_rows() -> list[tuple]:
    """Nulls, empty and white texts, ties, repeated rows, a long text, and copies."""
    passage = prose(77, 120)
    texts = [
        (1, prose(1, 200)), (2, prose(1, 200)), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one two three"), (8, "Ünï çödé 😀 " * 60),
        (9, prose(2, 90) + " " + passage + " " + prose(3, 80)), (10, prose(4, 70) + " " + passage), (11, "a" * 3000), (12, "abc" * 700),
        (13, prose(5, 20_000)), (None, prose(6, 30)), (None, None), (14, prose(8, 50)), (14, prose(8, 50)), (14, prose(9, 50)),
        (15, "\x00 nul ▁ mark"), (16, prose(10, 150) + " end"), (17, prose(10, 150) + " fin"), (-3, prose(11, 60)),
    ]
    return [(i, t, "en" if k % 3 else None, None if k % 4 else "s", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def wide_docs(spark, edge_docs):
    """The edge rows with columns that clash with the operators' own names."""
    from pyspark.sql import functions as F

    out = edge_docs
    for name in CLASHES:
        out = out.withColumn(name, F.lit("mine"))
    return out
