"""Vector codes: product quantisation whose nearest entries are found by bitmasks.

A vector is cut into equal consecutive parts; each part is written as the index
of the nearest entry of that part position's codebook (at most 64 entries).

**Slice and intersect.** For each dimension of a part the entries' coordinates
are sorted, and for every prefix of that order a uint64 mask says which entries
are in it. A vector's part takes the entries next to it in single dimensions as
guesses; the least of their distances is the initial radius. No nearer entry,
and none as near, lies further off than that radius in any dimension, so in each
dimension a range of the sorted coordinates holds them all: two prefix masks
give the range's entries, and the masks of all dimensions, ANDed, give the exact
candidates. Only these are measured.

Components become integers, ``floor(256 * x)``, and all arithmetic is exact.

* Dropped: vectors that are null, hold a null or a number that is not finite,
  are empty, cannot be cut into equal parts, or differ in length from the kept
  vector with the smallest id.
* Fewer kept vectors than entries make smaller codebooks; none at all, no rows.
* The smallest ids are taken with ties by content, rows without an id last.
  Rows that repeat count as often as they stand there.
* A component too large for exact distances in 64 bits (:func:`largest`; 2**18
  for 64 dimensions in 16 parts) raises an error that says so.

Codebooks have a fixed size (parts x 64 entries), whatever the table's; they are
all that is sent to tasks, and sums for each entry all that comes back.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A mask has one bit for each entry.
MOST_ENTRIES = 64
#: Vectors measured at a time within a task.
CHUNK = 16_384


class Slices:
    """One part position's codebook with its sorted coordinates and masks."""

    def __init__(self, entries: np.ndarray) -> None:
        k, m = entries.shape
        if not 1 <= k <= MOST_ENTRIES:
            raise ValueError(f"a codebook has 1 to {MOST_ENTRIES} entries")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.prefix = np.zeros((k + 1, m), np.uint64)
        self.prefix[1:] = np.bitwise_or.accumulate(bits, axis=0)

    def _radius(self, x: np.ndarray) -> np.ndarray:
        """At least the distance to the nearest entry, rounded up."""
        least = None
        for j in range(x.shape[1]):
            at = np.minimum(np.searchsorted(self.sorted[:, j], x[:, j]), len(self.entries) - 1)
            guess = ((x - self.entries[self.order[at, j]]) ** 2).sum(axis=1)
            least = guess if least is None else np.minimum(least, guess)
        return np.sqrt(least.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """For each row the mask of the entries within the radius in every dimension."""
        r = self._radius(x)
        masks = np.full(len(x), 2**64 - 1, np.uint64)
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - r, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + r, "right")
            masks &= self.prefix[high, j] & ~self.prefix[low, j]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry, the lowest of equals."""
        masks = self.candidates(x)
        best, found = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        for e in range(len(self.entries)):
            rows = np.flatnonzero(masks & np.uint64(1 << e))
            d = ((x[rows] - self.entries[e]) ** 2).sum(axis=1)
            nearer = d < best[rows]
            best[rows[nearer]], found[rows[nearer]] = d[nearer], e
        return found, best


def largest(width: int) -> int:
    """The largest component for which distances over ``width`` of them, and
    their sums over 64 parts, stay within 64 bits."""
    return math.isqrt(2**62 // (64 * 4 * max(1, width)))


def kept_vectors(table: DataFrame, parts: int, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, int]:
    """``(vec_id, label, v)`` of the vectors that are kept, as doubles, and their length (0: none)."""
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & finite)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    n = first["n"] if first else 0
    return rows.where(F.size("v") == n), n


def _whole(column: pa.Array, length: int, width: int) -> np.ndarray:
    """An Arrow list column of equal lengths as integer rows."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length) * 256.0)
    if x.size and np.abs(x).max() > largest(width):
        raise ValueError(f"a component is beyond {largest(width) / 256:g}; distances would not fit 64 bits")
    return x.astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            yield part, _whole(part.column("v"), length, width)


def _sums(kept: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sum of what each entry is nearest to: summed
    within tasks, then by Spark; parts x entries rows reach the driver."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for _, x in _chunks(batches, parts * width, width):
            for p, s in enumerate(slices):
                mine = x[:, p * width : (p + 1) * width]
                found, _ = s.nearest(mine)
                count[p] += np.bincount(found, minlength=k)
                for j in range(width):
                    np.add.at(total[p, :, j], found, mine[:, j])
        used = np.argwhere(count > 0)
        if len(used):
            p, e = used.T
            flat = pa.array(total[p, e].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * width), flat)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(count[p, e]), lists], names=["part", "entry", "n", "total"])

    got = kept.select("v").mapInArrow(run, "part long, entry long, n long, total array<long>")
    each = [F.sum(F.get("total", F.lit(j)).cast("decimal(38,0)")).alias(f"t{j}") for j in range(width)]
    rows = got.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(r[f"t{j}"]) for j in range(width)]) for r in rows}


def learn(kept: DataFrame, length: int, parts: int = 16, entries: int = MOST_ENTRIES, rounds: int = 2) -> np.ndarray:
    """Codebooks ``(parts, entries, width)``: the parts of the smallest ids'
    vectors, moved ``rounds`` times to the mean (rounded down) of what they are
    nearest to. Entries that nothing is nearest to stay."""
    width = length // parts
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    flat = pa.array([r["v"] for r in first], pa.list_(pa.float64()))
    books = _whole(flat, length, width).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for (p, e), (n, total) in _sums(kept, books).items():
            books[p, e] = [t // n for t in total]
    return books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``(vec_id, label, code, error)``: one index byte for each part, and the
    squared distance of vector and code."""
    parts, _, width = books.shape
    schema = kept.select("vec_id", "label").schema.add("code", "binary").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for part, x in _chunks(batches, parts * width, width):
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, s in enumerate(slices):
                found, d = s.nearest(x[:, p * width : (p + 1) * width])
                codes[:, p] = found
                error += d
            raw = codes.tobytes()
            code = pa.array([raw[i : i + parts] for i in range(0, len(raw), parts)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), code, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(run, schema)


def decode(coded: DataFrame, books: np.ndarray, code: str = "code", name: str = "decoded") -> DataFrame:
    """``coded`` with the integer vector that each code stands for."""
    flat = [[int(x) for x in e] for b in books for e in b]
    k = books.shape[1]
    entry = F.lit(flat) if flat else F.array()
    at = F.transform(F.sequence(F.lit(0), F.lit(books.shape[0] - 1)), lambda p: F.get(entry, p * k + F.conv(F.hex(F.substring(F.col(code), p + 1, F.lit(1))), 16, 10).cast("int")))
    return coded.withColumn(name, F.flatten(at))


def books_sha256(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
