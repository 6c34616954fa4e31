"""SimHash near-duplicates: fingerprints, bit-sliced comparison, components.

Two fingerprints within ``radius`` bits agree in all but ``radius`` of eight
byte-wide segments. So each distinct fingerprint goes to one bucket for every
choice of ``8 - radius`` segments, and any linked pair meets in one of them.
Members of a bucket differ only in the ``8 * radius`` free bits, which bounds
a bucket (65,536 distinct fingerprints at radius 2) whatever the input.

In a bucket, 64 fingerprints share one machine word per bit ("bit planes").
A fingerprint is compared with a word's 64 lanes at once: each plane's
differences enter a carry-save counter, and a word is abandoned once every
lane has left the radius. A bucket hands on a spanning forest of its links.

Rows with equal fingerprints are one node, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, durable, row_key, slices
from .components import connected_components

SEGMENTS = 8
PAIR_CHUNK = 1 << 18


# ------------------------------------------------------------ fingerprints
def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """64 majority bits over the hashes of ``words``-word shingles (repeats
    count; fewer words: one shingle of them all; no words: 0)."""
    parts = text.lower().split()          # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), seed)]
    else:
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], seed) for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 1 << 16):
        block = values[at : at + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``(doc_id, row_key, fp)`` per row, ``fp`` as a signed long. A null text
    counts as empty."""
    src = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(text).alias("text"))
    schema = src.drop("text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fps = np.array([fingerprint(b, words) for b in bytes_of(part, "text")], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps)], names=["doc_id", "row_key", "fp"])

    return src.mapInArrow(run, schema)


# ------------------------------------------------------ bit-sliced compare
def within_radius(values: np.ndarray, bits: int, runs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of one run whose ``bits``-bit values differ in at most
    ``radius`` bits. ``runs``: the start of each run, and the total length."""
    lengths = np.diff(runs)
    blocks = -(-lengths // 64)
    first = np.concatenate([[0], np.cumsum(blocks)])
    run_of = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(values)) - runs[:-1][run_of]
    block_of = first[run_of] + within // 64
    lane = (within % 64).astype(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], block_of[1:] != block_of[:-1]]))
    one, full = np.uint64(1), np.uint64(2**64 - 1)
    planes = np.stack([np.add.reduceat(((values >> np.uint64(p)) & one) << lane, starts) for p in range(bits)])
    used = np.add.reduceat(one << lane, starts)
    head = starts                                     # first member of each block
    todo = (first[1:][run_of] - block_of).astype(np.int64)   # blocks from a member's own on
    total, out = np.concatenate([[0], np.cumsum(todo)]), []
    width = max(2, (radius + 1).bit_length())
    for at in range(0, int(total[-1]), PAIR_CHUNK):
        item = np.arange(at, min(at + PAIR_CHUNK, int(total[-1])))
        q = np.searchsorted(total, item, side="right") - 1
        b = block_of[q] + item - total[q]
        live = used[b].copy()
        own = b == block_of[q]                        # in its own block: later lanes only
        live[own] &= ~((one << lane[q[own]]) | ((one << lane[q[own]]) - one))
        count = [np.zeros(len(q), np.uint64) for _ in range(width)]
        over = np.zeros(len(q), np.uint64)
        for p in range(bits):
            carry = planes[p][b] ^ np.where((values[q] >> np.uint64(p)) & one, full, np.uint64(0))
            for k in range(width):
                count[k], carry = count[k] ^ carry, count[k] & carry
            over |= carry
            if p % 4 == 3 or p == bits - 1:
                live &= ~(over | _above(count, radius))
                alive = live != 0
                if not alive.all():
                    q, b, live, over = q[alive], b[alive], live[alive], over[alive]
                    count = [c[alive] for c in count]
                if not len(q):
                    break
        if len(q):
            pair, bit = np.nonzero(np.unpackbits(live.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            out.append((q[pair], head[b[pair]] + bit))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds ``radius``, compared bit by bit from the top."""
    more = np.zeros_like(count[0])
    same = ~more
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same = same & count[k]
        else:
            more = more | (same & count[k])
            same = same & ~count[k]
    return more


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is linked to, itself included."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _bucket_links(radius: int):
    chosen = list(combinations(range(SEGMENTS), radius))
    shifts = np.array([[8 * s for s in c] for c in chosen], dtype=np.uint64)

    def links(combo: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        new = np.concatenate([[True], (combo[1:] != combo[:-1]) | (key[1:] != key[:-1])])
        starts = np.flatnonzero(new)
        lengths = np.diff(np.concatenate([starts, [len(fp)]]))
        keep = np.repeat(lengths > 1, lengths)
        if not keep.any():
            return None
        fp, combo = fp[keep], combo[keep]
        runs = np.concatenate([[0], np.cumsum(lengths[lengths > 1])])
        free = np.zeros(len(fp), np.uint64)
        for k in range(radius):
            free |= ((fp >> shifts[combo, k]) & np.uint64(255)) << np.uint64(8 * k)
        a, b = within_radius(free, 8 * radius, runs, radius)
        root = spanning_forest(len(fp), a, b)
        mine = np.flatnonzero(root != np.arange(len(fp)))
        if not len(mine):
            return None
        pair = np.stack([fp[mine].view(np.int64), fp[root[mine]].view(np.int64)])
        pair = np.unique(np.stack([pair.max(axis=0), pair.min(axis=0)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            got = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            now = got if held is None else [np.concatenate(x) for x in zip(held, got)]
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0    # the last bucket may go on
            held = [x[cut:] for x in now]
            if cut and (made := links(now[0][:cut], now[1][:cut], now[2][:cut].view(np.uint64))) is not None:
                yield made
        if held is not None and len(held[0]) and (made := links(held[0], held[1], held[2].view(np.uint64))) is not None:
            yield made

    return run


def fingerprint_links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct ``fp`` rows to ``(u, v)`` links that connect exactly what the
    pairs within ``radius`` bits connect. ``radius`` from 1 to 3."""
    if not 1 <= radius <= 3:
        raise ValueError("radius: 1 to 3")
    masks = []
    for c in combinations(range(SEGMENTS), radius):
        mask = ~sum(255 << (8 * s) for s in c) & (2**64 - 1)
        masks.append(mask - 2**64 if mask >= 2**63 else mask)
    keyed = nodes.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])).alias("k"), "fp"
    ).select("k.combo", "k.key", "fp")
    dealt = keyed.repartition("combo", "key").sortWithinPartitions("combo", "key", "fp")
    return dealt.mapInArrow(_bucket_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, row_key, fp, component_id, keeper)`` per row: the smallest
    doc_id reachable over links, and the row key of the row that stands for the
    component. Rows without an id take part; a component without any id has a
    null ``component_id``. Repeated rows have equal results."""
    rows = durable(fingerprints(docs, doc_id, text, words))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row_key"))
    nodes = durable(rows.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(fingerprint_links(nodes.select("fp"), radius))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("first").alias("least")), "root")
    named = named.select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.row_key").alias("keeper"))
    return rows.join(named, "fp").select("doc_id", "row_key", "fp", "component_id", "keeper")


def drop_near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, ids_once: bool = True) -> DataFrame:
    """``docs`` with one row of each component (the smallest doc_id; rows
    without an id come last). ``ids_once``: of rows left that repeat an id one
    stays, even if their texts are unrelated; turn it off where ids repeat
    across sources."""
    kept = near_duplicates(docs, words=words, radius=radius).select("keeper").distinct()
    name = "_row_key"
    while name in docs.columns:
        name = "_" + name
    keyed = docs.withColumn(name, row_key())
    out = keyed.join(kept, keyed[name] == kept["keeper"], "left_semi").dropDuplicates([name])
    if ids_once:
        out = out.withColumn(name, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.col(name)))).dropDuplicates([name])
    return out.select(*docs.columns)
