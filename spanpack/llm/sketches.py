"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions.

A sketch is the ``k`` least different 64-bit hashes of a text's word shingles,
in order. Two sketches merge to the sketch of both texts' shingles, and give
estimates of resemblance, containment and the number of different shingles.
All of it is built from array functions, row by row; nothing is exploded.

Null counts as empty. A text under ``words`` words is one shingle of them all;
an empty text has an empty sketch, which resembles an empty one fully and any
other not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

SKETCH, WORDS = 128, 5
_WORD_SPLIT = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words between white space, A-Z lowered."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, _WORD_SPLIT), lambda w: w != "")


def sketch(text: Column, k: int = SKETCH, words: int = WORDS) -> Column:
    """The ``k`` least hashes of the text's different shingles, ascending."""
    return F.transform(
        F.array(words_of(text)),   # bound once: the words are used several times below
        lambda w: F.slice(F.array_sort(F.array_distinct(_shingle_hashes(w, words))), 1, k),
    )[0]


def _shingle_hashes(w: Column, words: int) -> Column:
    # a hash of the words' hashes: shingles need not be built as strings
    each = F.transform(w, lambda x: F.xxhash64(x))
    return F.transform(
        F.array(each),
        lambda h: F.when(
            F.size(h) > words,
            F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)])),
        ).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")),
    )[0]


def merge(a: Column, b: Column, k: int = SKETCH) -> Column:
    """The sketch of the shingles of both."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_all(df: DataFrame, by: list[str], column: str, k: int = SKETCH) -> DataFrame:
    """One merged sketch for each group. Hashes are counted apart before they
    are gathered, and a group gathers ``k`` at most."""
    name = "_hash"
    rows = df.select(*by, F.explode(column).alias(name)).distinct()
    ranked = rows.withColumn("_part", F.pmod(F.col(name), F.lit(64)))
    least = ranked.withColumn("_n", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(name))).where(F.col("_n") <= k)
    return least.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(name)), 1, k).alias(column))


def resemblance(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated share of common shingles among all of both, from 0 to 1."""
    both = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both)).cast("double")


def distinct_shingles(a: Column, k: int = SKETCH) -> Column:
    """Estimated number of different shingles; exact below ``k``."""
    share = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has, from 0 to 1."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def hex_of(a: Column) -> Column:
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


#: Ranges that rows are dealt to, at most, and how finely their bounds are found.
MOST_PARTS, ACCURACY = 4_096, 16_384
_LEAST_LONG = -(2**63)


def _at_most(bounds: Column, count: int, value: Column, equal: bool) -> Column:
    """How many of ``count`` ascending bounds (padded to a power of two less
    one) lie below ``value``, with ``equal`` at most at it: a binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, count.bit_length())))])
    found = F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((F.get(bounds, at + step - 1) <= value) if equal else (F.get(bounds, at + step - 1) < value), at + step).otherwise(at))
    return F.least(found, F.lit(count))


def range_parts(rows: DataFrame, id_col: str, tie: str, per_part: int = 4_096) -> Column:
    """The number of the range that a row falls into: ranges follow the order by
    id (rows without one first), then by ``tie``, a 64-bit hash, and hold nearly
    equal numbers of rows however ids are spread. The bounds are quantiles over
    all rows; an id that fills several ranges is cut by its ties."""
    own = F.col(id_col).cast("long")
    key = F.when(own.isNull(), F.lit(_LEAST_LONG)).otherwise(F.greatest(own, F.lit(_LEAST_LONG + 1)))
    shares = [i / MOST_PARTS for i in range(1, MOST_PARTS)]
    n, all_bounds = rows.select(key.alias("k")).agg(F.count("*"), F.percentile_approx("k", shares, ACCURACY)).first()
    parts = max(1, min(MOST_PARTS, -(-n // per_part)))
    bounds = [all_bounds[i * MOST_PARTS // parts - 1] for i in range(1, parts)] if all_bounds else []
    if not bounds:
        return F.lit(0).cast("long")
    width = (1 << len(bounds).bit_length()) - 1
    text = ",".join(map(str, bounds + [2**63 - 1] * (width - len(bounds))))
    array = F.split(F.lit(text), ",").cast("array<bigint>")
    lower, upper = _at_most(array, len(bounds), key, False), _at_most(array, len(bounds), key, True)
    many = upper - lower
    share = F.col(tie).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    within = lower + 1 + F.least(many - 1, F.floor(share * many))
    return F.when(many <= 1, upper).otherwise(within).cast("long")


def with_next(rows: DataFrame, columns: list[str], id_col: str, tie: str, per_part: int = 4_096) -> DataFrame:
    """``rows`` with ``next_<column>`` for each of ``columns``: its value in the
    next row by descending ``id_col`` (after the last row the first), ties by
    descending ``tie``; rows without an id come last.

    Rows are dealt to ranges of nearly equal counts (:func:`range_parts`); a
    window finds the next row within a range, to which the first row of the
    following range is sent as well, so no window holds all rows. Only rows that
    repeat id and tie stand in one range however many they are."""
    part = range_parts(rows, id_col, tie, per_part)
    dealt = rows.withColumn("_part", part).withColumn("_extra", F.lit(False))
    slim = rows.select(id_col, tie).withColumn("_part", part)
    first = F.max(F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"), F.col(tie).alias("tie")))
    heads = durable(slim.groupBy("_part").agg(first.alias("h")))          # MOST_PARTS rows at most
    before = F.lag("_part").over(Window.orderBy(F.col("_part").desc()))
    last = heads.agg(F.min("_part").alias("_last"))
    sent = heads.select("_part", "h", before.alias("_to")).join(F.broadcast(last), F.lit(True)).select(
        F.col("_part").alias("_from"), F.coalesce("_to", "_last").alias("_to"), F.col("h.id").alias("_id"), F.col("h.tie").alias("_tie"))
    match = (F.col("_part") == F.col("_from")) & F.col(id_col).eqNullSafe(F.col("_id")) & (F.col(tie) == F.col("_tie"))
    extra = dealt.join(F.broadcast(sent), match).withColumn("_part", F.col("_to")).withColumn("_extra", F.lit(True)).select(*dealt.columns)
    order = Window.partitionBy("_part").orderBy("_extra", F.col(id_col).desc_nulls_last(), F.col(tie).desc())
    out = dealt.union(extra)
    for c in columns:
        out = out.withColumn(f"next_{c}", F.lead(c).over(order))
    return out.where(~F.col("_extra")).drop("_part", "_extra")
