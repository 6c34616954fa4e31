"""URL rules by a sorted sweep over reversed hosts.

A host's canonical key is its labels in reverse, each ended by ``\\x01``, so a
host and all its subdomains are one interval of keys: those that begin with the
host's key. Within a task a batch's URLs are sorted by key and swept together
with the rules, which are sorted too: a rule whose interval begins is pushed on
a stack, and popped when a key beyond it comes. The stack holds the rules
active for the present host, nested; of those whose path begins the URL's path
the longest rule (host and path together) decides, then the one with the longer
host, then ``block``.

URLs need no shuffle: every task sweeps its own rows, so a host with a third of
them is no hot key. Rules come in blocks of at most ``BLOCK_RULES``; each block
is broadcast and swept in turn, keeping the best rule so far.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules in a broadcast block.
BLOCK_RULES = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "net/es/")``: host up to the first slash, path from there."""
    if verdict not in ("allow", "block"):
        raise ValueError(f"verdict {verdict!r}")
    host, slash, rest = text.partition("/")
    return Rule(verdict, host.translate(str.maketrans(_UPPER, _LOWER)), slash + rest)


def reversed_key(host: str) -> str:
    return "".join(label + "\x01" for label in reversed(host.split("."))) if host else ""


def url_parts(url):
    """``(host, path)`` columns of a URL column; both empty for null or no ``://``."""
    url = F.coalesce(url, F.lit(""))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


class _Block:
    """Rules in key order, with what is needed to start a sweep at any key."""

    def __init__(self, rules: list[Rule]) -> None:
        made = sorted({(reversed_key(r.host), r) for r in rules}, key=lambda x: (x[0], x[1].path))
        self.keys = [k for k, _ in made]
        self.rules = [r for _, r in made]

    def open_at(self, key: str) -> int:
        """The first rule whose interval can hold ``key`` or a later one."""
        at, prefix = bisect_left(self.keys, key), ""
        first = at
        for label in key.split("\x01")[:-1]:
            for k in {prefix, prefix + label + "\x01"}:
                i = bisect_left(self.keys, k)
                if i < len(self.keys) and self.keys[i] == k:
                    first = min(first, i)
            prefix += label + "\x01"
        return first

    def sweep(self, rows: list[tuple[str, str, int]]) -> Iterator[tuple[int, Rule]]:
        """For ``(key, path, row)`` in key order, each row's best rule if it has one."""
        if not rows:
            return
        at, stack = self.open_at(rows[0][0]), []
        for key, path, row in rows:
            while at < len(self.keys) and self.keys[at] <= key:
                while stack and not self.keys[at].startswith(stack[-1][0]):
                    stack.pop()
                stack.append((self.keys[at], self.rules[at]))
                at += 1
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            best = max((r for _, r in stack if path.startswith(r.path)), key=rank, default=None)
            if best is not None:
                yield row, best


def rank(r: Rule) -> tuple:
    return len(r.text), len(r.host), r.verdict == "block", r.text


def judge_urls(pages: DataFrame, rules: Iterable[Rule], page_id: str = "page_id", url: str = "url", default: str = "allow", block_rules: int = BLOCK_RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row. A URL without a fitting
    rule has a null rule and the ``default`` verdict, as have null URLs and
    those without ``://``, whose host and path are empty."""
    host, path = url_parts(F.col(url))
    out = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    spark, source = pages.sparkSession, iter(rules)
    while block := list(islice(source, block_rules)):
        out = _judged(out, spark.sparkContext.broadcast(block))
    return out


def _judged(rows: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(shared.value)
        for batch in batches:
            hosts, paths, texts, verdicts = (batch.column(i).to_pylist() for i in (1, 2, 3, 4))
            keyed = sorted((reversed_key(h), p, i) for i, (h, p) in enumerate(zip(hosts, paths)))
            for i, r in block.sweep(keyed):
                if texts[i] is None or rank(r) > rank(rule(verdicts[i], texts[i])):
                    texts[i], verdicts[i] = r.text, r.verdict
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string()), pa.array(verdicts, pa.string())], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)

