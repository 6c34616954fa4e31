"""Exact-substring dedup: removes every byte that lies in a ``length``-byte
string starting at two places of the corpus.

1. **Windows to buckets.** A ``length``-byte window is dealt by its least
   ``anchor``-byte gram (leftmost on ties), which depends on the window alone,
   so equal windows meet. Neighbouring windows with the same gram travel as one
   row: the stretch they cover, named by hashes of gram and stretch. Stretches
   that are equal within a task are settled there; one row goes on for them.
2. **Buckets.** In anchor order, a stretch that occurs twice is settled: all of
   its windows repeat. Different stretches of one anchor may share some
   windows; only these need a closer look, one row for each different stretch.
3. **Suffix arrays.** Their text is fetched, and blocks of whole buckets are
   sorted with :mod:`lyndon` (what all stretches of a bucket share from the
   anchor on is one symbol). Windows that repeat are neighbours in that order;
   neighbours are compared byte by byte. A bucket with more different stretches
   than a block holds is settled by its windows' 128-bit hashes instead,
   dealt out by hash, so no task holds it whole.
4. **Spans.** Each document's spans are merged and cut.

Copies of a document count as other places. Null text counts as empty; rows
that repeat id and text get equal results; texts under ``length`` bytes lose
nothing. Documents may have any length: grams are hashed in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, durable, slices
from .lyndon import suffix_array

#: Symbols sorted at a time, and the most different stretches of one anchor that a block takes.
BLOCK_SYMBOLS = 16_384
BLOCK_STRETCHES = 4_096

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([i]), 7) for i in range(256)], dtype=np.uint64)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def _gram_order(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of every ``k``-byte gram."""
    n = len(data)
    up, down = _POWERS.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _leftmost_minima(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` values, where its leftmost least one is."""
    m = len(h)
    rows = -(-m // w)
    padded = np.full(rows * w, 2**64 - 1, np.uint64)
    padded[:m] = h
    at = np.arange(rows * w).reshape(rows, w)
    grid = padded.reshape(rows, w)
    best = np.minimum.accumulate(grid, axis=1)
    fresh = np.ones((rows, w), bool)
    fresh[:, 1:] = grid[:, 1:] < best[:, :-1]
    ahead = np.maximum.accumulate(np.where(fresh, at, 0), axis=1).ravel()
    back = grid[:, ::-1]
    least = np.minimum.accumulate(back, axis=1)
    fresh[:, 1:] = back[:, 1:] <= least[:, :-1]
    behind = np.minimum.accumulate(np.where(fresh, at[:, ::-1], rows * w), axis=1)[:, ::-1].ravel()
    n = m - w + 1
    left, right = behind[:n], ahead[w - 1 : w - 1 + n]
    return np.where(padded[left] <= padded[right], left, right)


def stretches(text: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, windows, anchor position)`` of the runs of ``length``-byte
    windows that share their least gram."""
    if len(text) < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    spot = _leftmost_minima(_gram_order(np.frombuffer(text, np.uint8), anchor), length - anchor + 1)
    starts = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]]))
    return starts, np.diff(np.concatenate([starts, [len(spot)]])), spot[starts]


# ------------------------------------------------------------- 1: windows
_ROW = "settled boolean, anchor long, stretch long, doc_id long, crc long, start int, windows int, spot int"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _rows(settled, anchor, stretch, doc_id, crc, start, windows, spot) -> pa.RecordBatch:
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    cols = (settled, anchor, stretch, doc_id, crc, start, windows, spot)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds)], names=_NAMES)


def _dealt(length: int, anchor: int):
    """Rows with ``settled`` are spans already: ``windows`` repeated windows from ``start``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, "text"):
                ids, texts = part.column(0), bytes_of(part, "text")
                which, begin, count, spots, ah, sh = [], [], [], [], [], []
                for i, t in enumerate(texts):
                    s, n, p = stretches(t, length, anchor)
                    if not len(s):
                        continue
                    view = memoryview(t)
                    which.append(np.full(len(s), i))
                    begin.append(s)
                    count.append(n)
                    spots.append(p - s)
                    ah += [named(view[x : x + anchor], 1) for x in p.tolist()]
                    sh += [named(view[x:y], 2) for x, y in zip(s.tolist(), (s + n - 1 + length).tolist())]
                if not which:
                    continue
                which, begin, count, spots = map(np.concatenate, (which, begin, count, spots))
                a, c = np.array(ah, np.uint64).view(np.int64), np.array(sh, np.uint64).view(np.int64)
                crc = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
                order = np.lexsort((c, a))
                same = (a[order[1:]] == a[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
                again, twice = np.concatenate([[False], same]), np.concatenate([same, [False]])
                shared = order[again | twice]
                if len(shared):      # settled here; the first row of each still goes on, for others to meet
                    yield _joined(which[shared], begin[shared], count[shared], ids, crc, length)
                for rows, twin in ((order[~again & ~twice], False), (order[~again & twice], True)):
                    if len(rows):
                        # a stretch that stands for two or more is marked by a negative count
                        yield _rows(np.zeros(len(rows), bool), a[rows], c[rows], ids.take(pa.array(which[rows])), crc[which[rows]], begin[rows], -count[rows] if twin else count[rows], spots[rows])

    return run


def _joined(which, begin, count, ids, crc, length) -> pa.RecordBatch:
    """Spans of repeated windows, those that touch joined, dealt out by document."""
    order = np.lexsort((begin, which))
    w, lo = which[order], begin[order]
    hi = lo + count[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (lo[1:] != hi[:-1])])   # runs of one text do not overlap
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(w)]]) - 1
    rows = w[at]
    dealt = crc[rows] * 0x9E3779B1 + lo[at]
    zero = np.zeros(len(at), np.int64)
    return _rows(np.ones(len(at), bool), dealt, zero, ids.take(pa.array(rows)), crc[rows], lo[at], hi[last] - lo[at], zero)


# ------------------------------------------------------------- 2: buckets
def _met():
    """Rows in anchor and stretch order to spans (settled) and to the different
    stretches of anchors that have several (not settled; a negative count: its
    own span is out already). Holds back one row, so a bucket of any size streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, int, int] | None = None      # anchor, stretch, first stretch of that anchor
        held: pa.RecordBatch | None = None
        for batch in batches:
            done = batch.filter(batch.column(0))
            if done.num_rows:
                yield done
            batch = batch.filter(pc.invert(batch.column(0)))
            if not batch.num_rows:
                continue
            now = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = now.slice(now.num_rows - 1)
            if now.num_rows > 1:
                made, before = _judge(now.slice(0, now.num_rows - 1), before, now)
                yield from made
        if held is not None:
            yield from _judge(held, before, held)[0]

    return run


def _judge(rows: pa.RecordBatch, before, ahead: pa.RecordBatch):
    """``ahead`` is ``rows`` and the row that follows, if any."""
    n = rows.num_rows
    a, c = (ahead.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
    count = rows.column(6).to_numpy(zero_copy_only=False)
    follows = np.zeros(n, bool)
    follows[: len(a) - 1] = (a[1:] == a[:-1])[:n]
    twin_next = np.zeros(n, bool)
    twin_next[: len(a) - 1] = ((a[1:] == a[:-1]) & (c[1:] == c[:-1]))[:n]
    a, c = a[:n], c[:n]
    known = before is not None and before[0] == a[0]
    led = np.concatenate([[known], a[1:] == a[:-1]])
    twin_last = np.concatenate([[known and before[1] == c[0]], (a[1:] == a[:-1]) & (c[1:] == c[:-1])])
    opening = np.maximum.accumulate(np.where(led, -1, np.arange(n)))
    first = np.where(opening >= 0, c[np.maximum(opening, 0)], before[2] if known else 0)
    settled = (count < 0) | twin_next | twin_last
    repeated = settled & (count > 0)                     # those with a negative count are out already
    several = (led & ~twin_last) | (~twin_next & follows & (c == first))
    made = []
    if repeated.any():
        part = rows.filter(pa.array(repeated))
        made.append(part.set_column(0, "settled", pa.array(np.ones(part.num_rows, bool))))
    if several.any():
        part = rows.filter(pa.array(several))
        sign = np.where(settled[several], -np.abs(count[several]), count[several]).astype(np.int32)
        made.append(part.set_column(6, "windows", pa.array(sign, pa.int32())))
    return made, (int(a[-1]), int(c[-1]), int(first[-1]))


# ------------------------------------------------------- 3: suffix arrays
_TEXTS = "anchor long, settled boolean, doc_id long, crc long, start int, windows int, spot int, body binary"
_ONE_ROW = ["anchor", "doc_id", "crc", "start"]
_SPANS = "doc_id long, crc long, start int, windows int"


def _bodies(length: int):
    """Documents with their open stretches to one row for each stretch, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _TEXTS.split(", ")]
        for batch in batches:
            for part in slices(batch, "text"):
                ids, out = part.column("doc_id").to_pylist(), [[] for _ in names]
                for i, crc, t, open_ in zip(ids, part.column("crc").to_pylist(), bytes_of(part, "text"), part.column("open").to_pylist()):
                    for r in open_:
                        n = abs(r["windows"])
                        for col, v in zip(out, (r["anchor"], r["windows"] < 0, i, crc, r["start"], n, r["spot"], t[r["start"] : r["start"] + n - 1 + length])):
                            col.append(v)
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return run


def _shared_prefix(parts: list[bytes]) -> int:
    lo, hi = min(parts), max(parts)
    n = min(len(lo), len(hi))
    if lo[:n] == hi[:n]:
        return n
    x, y = np.frombuffer(lo, np.uint8, n), np.frombuffer(hi, np.uint8, n)
    return int(np.argmax(x != y))


def repeated_windows(buckets: list[list[tuple[int, int, bytes]]], length: int, anchor: int) -> list[list[np.ndarray]]:
    """For buckets of ``(windows, spot, body)`` that share an anchor at ``spot``:
    for each body, which of its windows occur in another body of the bucket."""
    total = sum(map(len, buckets))
    pieces, flat, at = [], [], 0
    for b, bucket in enumerate(buckets):
        rest = _shared_prefix([body[spot + anchor :] for _, spot, body in bucket])
        for n, spot, body in bucket:
            data = np.frombuffer(body, np.uint8).astype(np.int64) + total
            pieces += [data[:spot], [total + 256 + b], data[spot + anchor + rest :], [total - 1 - len(flat)]]
            flat.append((at, n, body))
            at += spot + 1 + max(0, len(body) - spot - anchor - rest) + 1
    order = suffix_array(np.concatenate(pieces))
    owner, offset = np.full(at, -1), np.zeros(at, np.int64)
    for k, (lo, n, _) in enumerate(flat):
        owner[lo : lo + n] = k
        offset[lo : lo + n] = np.arange(n)
    order = order[owner[order] >= 0]
    who, off = owner[order].tolist(), offset[order].tolist()
    seen = [np.zeros(n, bool) for _, n, _ in flat]
    last = None
    for k, o in zip(who, off):
        window = flat[k][2][o : o + length]
        if window == last:
            seen[k][o] = True
            seen[k0][o0] = True
        last, k0, o0 = window, k, o
    out, k = [], 0
    for bucket in buckets:
        out.append(seen[k : k + len(bucket)])
        k += len(bucket)
    return out


def _spans_of(doc_ids, crcs, starts, flags) -> pa.RecordBatch | None:
    d, c, s, n = [], [], [], []
    for doc, crc, start, seen in zip(doc_ids, crcs, starts, flags):
        edge = np.diff(np.concatenate([[0], seen.view(np.int8), [0]]))
        for lo, hi in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            d.append(doc), c.append(crc), s.append(start + lo), n.append(hi - lo)
    if not d:
        return None
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], names=["doc_id", "crc", "start", "windows"])


def _sorted_blocks(length: int, anchor: int):
    def solve(buckets: list[list[dict]]) -> pa.RecordBatch | None:
        flags = repeated_windows([[(r["windows"], r["spot"], r["body"]) for r in b] for b in buckets], length, anchor)
        rows = [(r, f) for b, fs in zip(buckets, flags) for r, f in zip(b, fs) if not r["settled"]]
        return _spans_of([r["doc_id"] for r, _ in rows], [r["crc"] for r, _ in rows], [r["start"] for r, _ in rows], [f for _, f in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: list[list[dict]] = []
        held, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                this = [row[c] for c in _ONE_ROW]
                if this == last:
                    continue
                last = this
                if not buckets or buckets[-1][0]["anchor"] != row["anchor"]:
                    if held >= BLOCK_SYMBOLS:
                        if (made := solve(buckets)) is not None:
                            yield made
                        buckets, held = [], 0
                    buckets.append([])
                buckets[-1].append(row)
                held += len(row["body"]) - anchor + 2
        if buckets and (made := solve(buckets)) is not None:
            yield made

    return run


def _hashed_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, view = row["windows"], memoryview(row["body"])
                digests = [xxhash.xxh3_128_digest(view[o : o + length]) for o in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array([row["doc_id"]] * n, pa.int64()), pa.array([row["crc"]] * n, pa.int64()), pa.array(range(row["start"], row["start"] + n), pa.int32()), pa.array([1] * n, pa.int32())],
                    names=["digest", "doc_id", "crc", "start", "windows"])

    return run


# --------------------------------------------------------------- 4: spans
def _text_hash(text: Column) -> Column:
    """64 bits of a text, the same as in :func:`_dealt`."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, anchor: int | None = None, block_stretches: int = BLOCK_STRETCHES) -> DataFrame:
    """``(doc_id, crc, spans)`` of the documents that have any: the starts of
    repeated windows as ``array<struct<start, windows>>``, ``crc``, a
    64-bit hash of the text, telling rows apart that share a doc_id."""
    anchor = anchor or max(1, length * 7 // 10)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = src.mapInArrow(_dealt(length, anchor), _ROW)
    met = rows.repartition("anchor").sortWithinPartitions("anchor", "stretch").mapInArrow(_met(), _ROW)
    span = F.when(F.col("settled"), F.struct("start", "windows"))
    left = F.when(~F.col("settled"), F.struct("anchor", "start", "windows", "spot"))
    # sets: rows that repeat an id and a text bring the same spans, however many they are
    found = durable(met.groupBy("doc_id", "crc").agg(F.collect_set(span).alias("spans"), F.collect_set(left).alias("open")))

    # plain equality, so that one exchange of the texts serves both joins and the aggregate;
    # a null id and the least one share a key, and with equal texts they share their spans
    key = F.coalesce("doc_id", F.lit(-(2**63))).alias("key")
    unsettled = found.where(F.size("open") > 0).select(key, "doc_id", "crc", "open")
    keyed = src.select(key, _text_hash(F.col("text")).alias("crc"), "text")
    once = keyed.join(unsettled.select("key", "crc"), ["key", "crc"], "left_semi").groupBy("key", "crc").agg(F.first("text").alias("text"))
    fetched = unsettled.join(once, ["key", "crc"]).select("doc_id", "crc", "text", "open")
    bodies = durable(fetched.mapInArrow(_bodies(length), _TEXTS))
    many = bodies.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > block_stretches).select("anchor")
    sorted_ = bodies.join(many, "anchor", "left_anti").repartition("anchor").sortWithinPartitions(*_ONE_ROW).mapInArrow(_sorted_blocks(length, anchor), _SPANS)
    hashed = bodies.join(many, "anchor", "left_semi").mapInArrow(_hashed_windows(length), "digest binary, " + _SPANS).distinct()
    twice = hashed.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    closer = sorted_.union(hashed.join(twice, "digest", "left_semi").select("doc_id", "crc", "start", "windows"))
    closer = closer.groupBy("doc_id", "crc").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    return found.select("doc_id", "crc", "spans").union(closer).groupBy("doc_id", "crc").agg(F.flatten(F.collect_list("spans")).alias("spans")).where(F.size("spans") > 0)


def merged(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the windows, in order, apart from each other."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["start"], s["start"] + s["windows"] - 1 + length) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, spans: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    """``docs`` with the array of spans as one more column, and its name."""
    name = "_spans"
    while name in docs.columns:
        name = "_" + name
    right = spans.select(F.col("doc_id").alias("_d"), F.col("crc").alias("_c"), F.col("spans").alias(name))
    left = docs.alias("l")
    on = F.col(f"l.`{doc_id}`").cast("long").eqNullSafe(F.col("r._d")) & (_text_hash(F.col(f"l.`{text}`")) == F.col("r._c"))
    joined = left.join(right.alias("r"), on, "left")
    return joined.select(*[F.col(f"l.`{c}`") for c in docs.columns], F.col(f"r.{name}")), name


def cut_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, anchor: int | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)`` per row: removed byte
    ranges and the bytes that remain (not always valid UTF-8)."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined, name = _with_spans(src, repeated_spans(src, length=length, anchor=anchor), "doc_id", "text")
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<lo:long,hi:long>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                size, gone, cuts, kept = [], [], [], []
                for t, s in zip(bytes_of(part, "text"), part.column(name).to_pylist()):
                    ranges = merged(s or [], length)
                    size.append(len(t))
                    gone.append(sum(b - a for a, b in ranges))
                    cuts.append([{"lo": a, "hi": b} for a, b in ranges])
                    kept.append(without(t, ranges))
                kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return joined.mapInArrow(run, schema)


def without(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    if not ranges:
        return text
    edges = [0, *[x for r in ranges for x in r], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without characters that they only cut into."""
    out = []
    for a, b in ranges:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def cut_texts(docs: DataFrame, length: int = 400, anchor: int | None = None) -> DataFrame:
    """``docs`` with its columns, the repeated text cut out at whole characters
    and ``n_chars`` counted anew. A null text stays null."""
    joined, name = _with_spans(docs, repeated_spans(docs, length=length, anchor=anchor), "doc_id", "text")
    columns, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = []
                for t, s in zip(part.column("text").to_pylist(), part.column(name).to_pylist()):
                    if t is not None and s:
                        raw = t.encode()
                        t = without(raw, whole_characters(raw, merged(s, length))).decode()
                    texts.append(t)
                cols = [part.column(c) for c in columns]
                cols[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=columns)

    cut = joined.mapInArrow(run, docs.schema)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut
