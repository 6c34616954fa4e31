"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import xxhash


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def simhash(text: str | None, words: int = 3) -> int:
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [b" ".join(parts)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids: list, fps: list[int], radius: int = 2) -> list:
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(fps)):
        groups[find(i)].append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(fps))]


def cut(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] += 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def _signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def sketch(text: str, k: int = 128, words: int = 5) -> list[int]:
    import re

    low = text.translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]

    def chained(values: list[int]) -> int:
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), seed)
        return seed

    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    shingles = [h[i : i + words] for i in range(len(h) - words + 1)] if len(h) > words else [h] if h else []
    return sorted({_signed(chained(s)) for s in shingles})[:k]


def resemblance(a: list[int], b: list[int], k: int = 128) -> float:
    both = sorted({*a, *b})[:k]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def edited(docs: list[tuple[int, str]]) -> dict[int, tuple[str, str]]:
    """Unique ids: each with its edited text and the next text."""
    order = sorted(docs, reverse=True)
    out = {}
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        out[i] = (t[: len(t) - half] + n[:half], n)
    return out


def least_capacity(sizes: list[int], shards: int) -> int:
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        used, held = 1, 0
        for s in sizes:
            if held + s > mid:
                used, held = used + 1, 0
            held += s
        lo, hi = (lo, mid) if used <= shards else (mid + 1, hi)
    return lo


def edit_distance_inside(item: str, text: str) -> int:
    """Fewest edits that turn ``item`` into some substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())
