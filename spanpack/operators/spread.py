"""Joins of records to a lookup table where a few keys hold much of the records.

A hash join sends all records of one key to one task. Here the heavy keys are
counted first, their records are dealt into parts by a hash, and the lookup rows
of these keys are repeated once a part; all other keys join as they are.

``split_by_weight`` sets the records of heavy keys apart, for work by key that
may deal all other records by their key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key is heavy with more than one of so many equal shares of the rows. Fewer
#: than ``PARTS`` keys can be, so the table of them is bounded whatever the input.
PARTS = 1024

#: Keys are weighed in so many buckets, so their weights are bounded like the keys.
BUCKETS = 1 << 14

_KEY, _SHARES, _LEFT, _RIGHT, _BUCKET = "_heavy_key", "_heavy_shares", "_record_part", "_lookup_part", "_bucket"


def heavy_keys(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """``(_heavy_key, _heavy_shares)``: keys with more than ``1 / parts`` of the
    rows that have a key, and that share in ``1 / parts``, rounded up.

    Counts are exact and merge map-side, so a hot key sends one row a task; the
    total is one row. Keys of NULL are no key."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total"))
    heavy = counts.crossJoin(F.broadcast(total)).where(F.col("_rows") * parts > F.col("_total"))
    return heavy.select(_KEY, F.ceil(F.col("_rows") * parts / F.col("_total")).cast("int").alias(_SHARES))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def spread_join(
    records: DataFrame,
    lookup: DataFrame,
    record_key: str,
    lookup_key: str,
    parts: int = PARTS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join of ``records`` to ``lookup``, the same rows as
    ``records.join(lookup, record_key == lookup_key)``, without a hot task.

    Records of a heavy key are dealt by a hash of their columns and the number
    of their input partition, so that copies of one record part too; both are
    the same when a lost task runs again.

    ``counted`` holds the ``record_key`` of all records before filters on other
    columns, where that is cheaper to read: it only decides how many parts a key
    gets, never which rows come out."""
    heavy = heavy_keys(records if counted is None else counted, record_key, parts)
    hashed = [_quoted(f.name) for f in records.schema.fields if not _has_map(f.dataType)]
    shares = F.coalesce(F.col(_SHARES), F.lit(1))
    dealt = records.where(F.col(record_key).isNotNull()).join(F.broadcast(heavy), F.col(record_key) == F.col(_KEY), "left")
    dealt = dealt.withColumn(_LEFT, F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), shares).cast("int")).drop(_KEY, _SHARES)
    copies = lookup.join(F.broadcast(heavy), F.col(lookup_key) == F.col(_KEY), "left")
    copies = copies.withColumn(_RIGHT, F.explode(F.sequence(F.lit(0), shares - 1))).drop(_KEY, _SHARES)
    joined = dealt.join(copies, (F.col(record_key) == F.col(lookup_key)) & (F.col(_LEFT) == F.col(_RIGHT)))
    return joined.drop(_LEFT, _RIGHT)


def _has_map(dtype: T.DataType) -> bool:
    """Whether a type holds maps, which cannot be hashed."""
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def split_by_weight(
    tables: Sequence[DataFrame], keys: Sequence[str], counted: Sequence[DataFrame] | None = None, parts: int = PARTS
) -> list[tuple[DataFrame, DataFrame]]:
    """(light, heavy) rows of each table. Heavy are the keys of a bucket with more
    than ``1 / parts`` of the rows of all tables, so no light key has more than that.

    Keys are counted by bucket, merged map-side, in one more read of their columns
    (of ``counted`` if given): the tables should be cheap to read, as stored ones are.
    A key is light or heavy in all tables alike."""
    bucket = F.pmod(F.hash(*[_quoted(k) for k in keys]), F.lit(BUCKETS))
    weighed = [t.select(bucket.alias(_BUCKET)) for t in (tables if counted is None else counted)]
    every = weighed[0]
    for w in weighed[1:]:
        every = every.union(w)
    heavy = F.broadcast(heavy_keys(every, _BUCKET, parts).select(_KEY))
    marked = [t.withColumn(_BUCKET, bucket) for t in tables]
    same = F.col(_BUCKET) == F.col(_KEY)
    return [(t.join(heavy, same, "left_anti").drop(_BUCKET), t.join(heavy, same, "left_semi").drop(_BUCKET)) for t in marked]
