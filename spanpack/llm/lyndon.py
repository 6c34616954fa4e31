"""Suffix arrays by Lyndon grouping (Baier, "Linear-time Suffix Sorting", 2016).

Phase 1 groups suffixes by their longest Lyndon prefix: groups are taken in
descending order, each member points to the nearest earlier suffix of a lower
group (its previous smaller one), and the suffixes pointed at are split off
above the rest of their own group, those hit more often further up. Phase 2
walks the order from the smallest suffix and places, along the same pointers,
each suffix at the next free place of its group. No names are assigned anew
and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The suffix order of an integer text whose last symbol is its only least one."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    low = symbols.min()
    if symbols[-1] != low or np.count_nonzero(symbols == low) != 1:
        raise ValueError("the last symbol must be the only least one")
    group, prev = _lyndon_groups(symbols)
    return np.array(_emit(group, prev), dtype=np.int64)


def _lyndon_groups(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """Each suffix's group, named by where it starts in the order, and pointer."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(symbols[order]) != 0]))
    extents = np.diff(np.concatenate([heads, [n]]))
    named, at = np.empty(n, np.int64), np.empty(n, np.int64)
    named[order] = np.repeat(heads, extents)
    at[order] = np.arange(n)
    sizes = np.zeros(n, np.int64)
    sizes[heads] = extents
    place, group, size, where = order.tolist(), named.tolist(), sizes.tolist(), at.tolist()
    prev = [-1] * n

    end = n
    while end:
        head = group[place[end - 1]]
        if head == end - 1:                       # one member: the common case
            i = place[head]
            j = i - 1
            while j >= 0 and group[j] >= head:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                g = group[j]
                s = size[g]
                if s > 1:
                    top = g + s - 1
                    p, o = where[j], place[top]
                    place[p], place[top] = o, j
                    where[o], where[j] = p, top
                    group[j] = top
                    size[g], size[top] = s - 1, 1
        else:
            hits: dict[int, int] = {}
            for i in sorted(place[head:end]):
                j = i - 1
                while j >= 0 and group[j] >= head:
                    j = prev[j]
                prev[i] = j
                if j >= 0:
                    hits[j] = hits.get(j, 0) + 1
            by_count: dict[int, list[int]] = {}
            for j, c in hits.items():
                by_count.setdefault(c, []).append(j)
            for c in sorted(by_count, reverse=True):
                by_group: dict[int, list[int]] = {}
                for j in by_count[c]:
                    by_group.setdefault(group[j], []).append(j)
                for g, members in by_group.items():
                    s, k = size[g], len(members)
                    if k == s:
                        continue
                    top, fresh = g + s, g + s - k
                    for j in members:
                        top -= 1
                        p, o = where[j], place[top]
                        place[p], place[top] = o, j
                        where[o], where[j] = p, top
                        group[j] = fresh
                    size[g], size[fresh] = s - k, k
        end = head
    return group, prev


def _emit(group: list[int], prev: list[int]) -> list[int]:
    n = len(group)
    free, done, out = list(range(n)), bytearray(n), [0] * n
    out[0] = n - 1
    done[n - 1] = 1
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = 1
            j = prev[j]
    return out
