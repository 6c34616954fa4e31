"""A bidirectional FM-index over word ids, searched breadth first.

The text is a sequence of word ids (1 and up) with 0 between pieces. One index
stands over the sequence and one over its reverse; both order positions by their
first ``depth`` words only, which is all that phrases of up to ``depth`` words
ask for. A phrase is a pair of intervals, one in each index. Extending it by a
word to the left is a step of backward search in the first index (the word's
range there comes from the last-to-first mapping), while its interval in the
second narrows by the number of smaller words before it; extending to the right
is the mirror image. All phrases of a length are extended in one sweep of numpy
operations.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np


@dataclass
class Phrases:
    """Different phrases of one length: their words and their intervals in the
    index and in the reverse one (both of the same size, the phrase's count)."""

    words: np.ndarray        # (phrases, length)
    low: np.ndarray
    back: np.ndarray
    count: np.ndarray

    def where(self, keep: np.ndarray) -> "Phrases":
        return Phrases(self.words[keep], self.low[keep], self.back[keep], self.count[keep])


def _order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions by their first ``depth`` symbols (the sequence runs around)."""
    rank, covered = seq.astype(np.int64), 1
    while covered < depth:
        step = min(covered, depth - covered)
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        _, rank = np.unique(key, return_inverse=True)
        covered += step
    return np.argsort(rank, kind="stable")


class _Side:
    """One Burrows-Wheeler transform and its last-to-first mapping."""

    def __init__(self, seq: np.ndarray, depth: int) -> None:
        self.bwt = seq[_order(seq, depth) - 1]
        self.first = np.empty(len(seq), np.int64)
        self.first[np.argsort(self.bwt, kind="stable")] = np.arange(len(seq))

    def extend(self, low: np.ndarray, count: np.ndarray, symbols: int) -> tuple[np.ndarray, ...]:
        """For each interval and each word before it: which interval, the word,
        its new interval's start here, how many rows of the interval have a
        smaller word, and the count."""
        which = np.repeat(np.arange(len(low)), count)
        begins = np.cumsum(count) - count
        rows = np.arange(len(which)) - begins[which] + low[which]
        key = which * symbols + self.bwt[rows]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([at, [len(ordered)]]))
        one, word = np.divmod(ordered[at], symbols)
        keep = word > 0
        smaller = at - begins[one]
        return one[keep], word[keep], self.first[rows[order[at]]][keep], smaller[keep], size[keep]


class WordIndex:
    """Both sides over one sequence of ids in ``0 .. symbols - 1`` (2**21 at
    most), each made when it is first asked for."""

    def __init__(self, seq: np.ndarray, symbols: int, depth: int) -> None:
        seq = np.concatenate([[0], np.asarray(seq, np.int64), [0]])
        self.symbols, self.depth = symbols, depth
        self.seq, self.counts = seq, np.bincount(seq, minlength=symbols)

    @cached_property
    def ahead(self) -> _Side:
        return _Side(self.seq, self.depth)

    @cached_property
    def behind(self) -> _Side:
        return _Side(self.seq[::-1], self.depth)

    def words(self) -> Phrases:
        """All single words."""
        present = np.flatnonzero(self.counts[1:]) + 1
        low = (np.cumsum(self.counts) - self.counts)[present]
        return Phrases(present[:, None], low, low.copy(), self.counts[present])

    def to_left(self, p: Phrases) -> Phrases:
        """Every phrase that has one of ``p`` after its first word."""
        one, word, low, smaller, count = self.ahead.extend(p.low, p.count, self.symbols)
        return Phrases(np.column_stack([word, p.words[one]]), low, p.back[one] + smaller, count)

    def to_right(self, p: Phrases) -> Phrases:
        """Every phrase that has one of ``p`` before its last word."""
        one, word, back, smaller, count = self.behind.extend(p.back, p.count, self.symbols)
        return Phrases(np.column_stack([p.words[one], word]), p.low[one] + smaller, back, count)


def longer(index: WordIndex, triples: Phrases, most: int) -> list[Phrases]:
    """Phrases of 4 to ``most`` words, by length, all of whose neighbouring
    three words are among ``triples``: grown to the left and to the right in
    turn, so both ends are checked as they appear."""

    def key(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a * index.symbols + b) * index.symbols + c

    known = np.sort(key(*triples.words.T))
    out, now = [], triples
    for length in range(4, most + 1):
        right = length % 2 == 1
        now = index.to_right(now) if right else index.to_left(now)
        ends = now.words[:, -3:] if right else now.words[:, :3]
        got = key(*ends.T)
        at = np.minimum(np.searchsorted(known, got), max(0, len(known) - 1))
        now = now.where(known[at] == got if len(known) else np.zeros(len(got), bool))
        out.append(now)
    return out
