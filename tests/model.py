"""Brute-force interval packing in plain Python (test oracle only)."""

from __future__ import annotations


def pack(intervals, grace):
    """intervals: [(start, end)] ints with end >= start. Returns sorted
    [(start, end, count, stockpile_gap, covered_gap)]."""
    runs = []
    for s, e in sorted(intervals):
        if runs and s <= runs[-1][1] + grace:
            runs[-1][1] = max(runs[-1][1], e)
            runs[-1][2].append((s, e))
        else:
            runs.append([s, e, [(s, e)]])
    out = []
    for s, e, members in runs:
        summed = sum(b - a for a, b in members)
        covered = len({d for a, b in members for d in range(a, b)})
        out.append((s, e, len(members), (e - s) - summed, (e - s) - covered))
    return out


def pack_members(intervals, grace):
    """Like :func:`pack` but returns [(era_start, era_end, [member indexes])]
    for intervals given as a list; members keep their input index."""
    order = sorted(range(len(intervals)), key=lambda i: intervals[i])
    runs = []
    for i in order:
        s, e = intervals[i]
        if runs and s <= runs[-1][1] + grace:
            runs[-1][1] = max(runs[-1][1], e)
            runs[-1][2].append(i)
        else:
            runs.append([s, e, [i]])
    return [(s, e, members) for s, e, members in runs]
