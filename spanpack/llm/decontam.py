"""Benchmark decontamination by the q-gram lemma.

An item of ``m`` code points that occurs in a text with at most ``e`` edits
shares at least ``m - q + 1 - q * e`` q-grams with it, all on diagonals that
lie within ``e`` of each other. Overlapping bands of ``2 (e + 1)`` diagonals
(one begins every ``e + 1``) therefore hold all of them in some band. Shared
q-grams are counted for each text, item and band; bands that reach the bound
are verified by an alignment kept to the band, which also gives place and edits.

``e`` is ``rate`` of the item's length, less where an item is too short for
the bound to be positive. An item under ``q`` code points has no q-gram; it is
looked up as it is, between characters that are no letters or digits. An item of
over ``PART_CHARS`` code points is matched in parts of equal length, each with a
budget of its own, so a region may be a part of such an item; of shorter items
only the whole matches. Letters A-Z match a-z, and a run of white space matches
any other; regions are given in the text as it stands. Items that are empty, or
white space only, never match.

Items are a stated query set. They are read in blocks of at most
``BLOCK_CHARS`` code points; each block is broadcast and scanned against all
texts, so what is broadcast is bounded whatever the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, slices, texts_of

GRAM, RATE = 10, 0.08
BLOCK_CHARS = 2_000_000
#: The longest stretch of an item that is aligned at a time.
PART_CHARS = 4_000
#: Code points of text that are looked up at a time.
SCAN_CHARS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BITS = 22


def plain_codes(text: str) -> np.ndarray:
    """Code points, A-Z lowered and white space as one space each; no length changes."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint32)
    c[(c >= 65) & (c <= 90)] += 32
    c[(c == 9) | (c == 10) | (c == 11) | (c == 12) | (c == 13) | (c == 0xA0) | ((c >= 0x2000) & (c <= 0x200A)) | (c == 0x3000)] = 32
    return c


def collapsed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """:func:`plain_codes` with one space for each run of white space, and
    where in the text each code stands."""
    c = plain_codes(text)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    return c[keep], np.flatnonzero(keep)


def _trimmed(codes: np.ndarray) -> np.ndarray:
    return codes[int(len(codes) > 0 and codes[0] == 32) : len(codes) - int(len(codes) > 1 and codes[-1] == 32)]


def _parts(codes: np.ndarray) -> list[np.ndarray]:
    return np.array_split(codes, max(1, -(-len(codes) // PART_CHARS)))


def _string(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le")


def edit_budget(m: int, q: int = GRAM, rate: float = RATE) -> int:
    """Edits that an item of ``m`` code points may show (-1: it never matches)."""
    return min(int(rate * m), (m - q) // q) if m >= q else -1


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    n = max(0, len(codes) - q + 1)
    h = np.zeros(n, np.uint64)
    for i in range(q):
        h = h * np.uint64(_BASE) + codes[i : i + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Items:
    """The q-gram index of one block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int = GRAM, rate: float = RATE) -> None:
        self.q = q
        whole = [(i, _trimmed(collapsed(t)[0])) for i, t in items]
        self.short = ahocorasick.Automaton()
        for i, c in whole:
            if 0 < len(c) < q:
                word = _string(c)
                self.short.add_word(word, (len(word), [*self.short.get(word, (0, []))[1], i]))
        self.short.make_automaton()
        coded = [(i, part) for i, c in whole for part in _parts(c) if edit_budget(len(part), q, rate) >= 0]
        self.ids = [i for i, _ in coded]
        self.codes = [c for _, c in coded]
        self.m = np.array([len(c) for c in self.codes], np.int64)
        self.e = np.array([edit_budget(len(c), q, rate) for c in self.codes], np.int64)
        self.bound = self.m - q + 1 - q * self.e
        grams = [_grams(c, q) for c in self.codes]
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.place = item[order], place[order]
        self.hash, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def candidates(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, item, lowest diagonal)`` of the bands that reach their item's bound."""
        found = []
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (held < SCAN_CHARS or end == at):
                held += len(texts[end]) + 1
                end += 1
            got = self._scan(texts[at:end])
            found.append((got[0] + at, got[1], got[2]))
            at = end
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, none
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))

    def _scan(self, texts: list[np.ndarray]):
        gap = np.array([0], np.uint32)
        joined = np.concatenate([x for t in texts for x in (t, gap)])
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        h = _grams(joined, self.q)
        pos = np.flatnonzero(self.filter[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        where = np.searchsorted(self.hash, h[pos])
        where[where == len(self.hash)] = 0
        same = self.hash[where] == h[pos] if len(self.hash) else np.zeros(0, bool)
        pos, where = pos[same], where[same]
        n = self.count[where]
        pick = np.repeat(self.first[where] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pos = np.repeat(pos, n)
        item, diagonal = self.item[pick], pos - self.place[pick]
        text = np.searchsorted(begins, pos, side="right") - 1
        diagonal = diagonal - begins[text]                     # from minus the item's length on
        width = self.e[item] + 1
        band = (diagonal + self.m[item]) // width              # each diagonal lies in this band and the one below
        span = int(band.max(initial=0)) + 2
        key = (text * max(1, len(self.ids)) + item) * span + band + 1
        key, hits = np.unique(key, return_counts=True)
        key = np.concatenate([key, key - 1])
        total = np.concatenate([hits, hits])
        key, back = np.unique(key, return_inverse=True)
        total = np.bincount(back, weights=total, minlength=len(key)).astype(np.int64)
        band, rest = key % span - 1, key // span
        item, text = rest % max(1, len(self.ids)), rest // max(1, len(self.ids))
        good = total >= self.bound[item] if len(self.ids) else np.zeros(0, bool)
        item, text, band = item[good], text[good], band[good]
        return text, item, band * (self.e[item] + 1) - self.m[item]

    def align(self, texts: list[np.ndarray], text: np.ndarray, item: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(edits, start, end)`` of the best alignment of the whole item within
        each band of ``2 (e + 1)`` diagonals from ``low`` on, all bands at once."""
        best = np.zeros((3, len(text)), np.int64)
        order = np.argsort(self.e[item], kind="stable")
        for lot in np.array_split(order, max(1, -(-len(order) // 512))):
            if len(lot):
                best[:, lot] = self._align(texts, text[lot], item[lot], low[lot])
        return best[0], best[1], best[2]

    def _align(self, texts, text, item, low):
        c, rows, span = len(text), int(self.m[item].max()), 2 * int(self.e[item].max() + 1)
        unit = np.int64(1) << 32
        width = rows + span
        window = np.zeros((c, width), np.uint32)
        pattern = np.full((c, rows), 0xFFFFFFFF, np.uint32)
        for k in range(c):
            t, d = texts[text[k]], int(low[k])
            a, b = max(0, d), min(len(t), d + width)
            if a < b:
                window[k, a - d : b - d] = t[a:b]
            p = self.codes[item[k]]
            pattern[k, : len(p)] = p
        j = np.arange(span)
        outside = j >= 2 * (self.e[item] + 1)[:, None]
        far = np.int64(1) << 60
        cost = np.where(outside, far, np.broadcast_to(j, (c, span)))     # edits * unit + where it began
        result = np.zeros((3, c), np.int64)
        for r in range(rows):
            miss = (window[:, r : r + span] != pattern[:, r : r + 1]).astype(np.int64) * unit
            down = np.full((c, span), far)
            down[:, :-1] = cost[:, 1:] + unit
            now = np.minimum(cost + miss, down)
            now = np.where(outside, far, now) - j * unit
            cost = np.minimum.accumulate(now, axis=1) + j * unit
            cost = np.where(outside, far, cost)
            for k in np.flatnonzero(self.m[item] == r + 1):
                at = int(cost[k].argmin())
                start = int(cost[k, at] % unit) + int(low[k])
                size = len(texts[text[k]])
                result[:, k] = int(cost[k, at] // unit), min(max(start, 0), size), min(max(r + 1 + int(low[k]) + at, 0), size)
        return result

    def leaks(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text its verified regions ``(item id, start, end, edits)``
        in code points; of regions of one item that overlap, the best."""
        both = [collapsed(t) for t in texts]
        coded = [c for c, _ in both]
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if len(self.short):
            for t, c in enumerate(coded):
                out[t] += self._exact(_string(c))
        if self.ids and coded:
            self._similar(coded, out)
        for rows, (_, back) in zip(out, both):
            rows[:] = [(i, int(back[a]), int(back[b - 1]) + 1, d) for i, a, b, d in rows]
        return out

    def _exact(self, text: str) -> list[tuple[int, int, int, int]]:
        """Where short items stand between characters that are no letters or digits."""
        found = []
        for last, (n, ids) in self.short.iter(text):
            a, b = last + 1 - n, last + 1
            if not (a and text[a - 1].isalnum() and text[a].isalnum()) and not (b < len(text) and text[b].isalnum() and text[b - 1].isalnum()):
                found += [(i, a, b, 0) for i in ids]
        return found

    def _similar(self, coded: list[np.ndarray], out: list[list[tuple[int, int, int, int]]]) -> None:
        text, item, low = self.candidates(coded)
        edits, start, end = self.align(coded, text, item, low)
        good = (edits <= self.e[item]) & (end > start)
        rows = sorted(zip(text[good].tolist(), item[good].tolist(), edits[good].tolist(), start[good].tolist(), end[good].tolist()))
        for t, i, d, a, b in rows:
            if not any(x[0] == self.ids[i] and a < x[2] and x[1] < b for x in out[t]):
                out[t].append((self.ids[i], a, b, d))


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``block_chars`` code points (one item at
    least), read one partition at a time; null texts are left out."""
    block, held = [], 0
    for r in items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull()).toLocalIterator():
        if block and held + len(r["t"]) > block_chars:
            yield block
            block, held = [], 0
        block.append((r["i"], r["t"]))
        held += len(r["t"])
    if block:
        yield block


def benchmark_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)``: a row for each verified region,
    in code points of the text. Null and empty texts have none."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = items.schema[item_id].dataType
    schema = src.drop("text").schema.add("item_id", id_type).add("start", "long").add("end", "long").add("edits", "long")

    def scan(block):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(shared.value)
            for batch in batches:
                for part in slices(batch, "text"):
                    found = [(k, *r) for k, rows in enumerate(index.leaks(texts_of(part, "text"))) for r in rows]
                    ids = part.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                    numbers = [pa.array([f[c] for f in found], pa.int64()) for c in (2, 3, 4)]
                    kind = batch_type
                    yield pa.RecordBatch.from_arrays([ids, pa.array([f[1] for f in found], kind), *numbers], names=schema.names)

        return src.mapInArrow(run, schema)

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(id_type)
    scans = [scan(b) for b in item_blocks(items, item_id, item_text, block_chars)]
    return reduce(DataFrame.union, scans) if scans else src.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no region of any item, as they are."""
    for block in item_blocks(items, block_chars=block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def judge(shared=shared):
            index = Items(shared.value)
            return lambda texts: [not r for r in index.leaks(texts)]

        docs = keep_rows(docs, "text", judge)
    return docs
