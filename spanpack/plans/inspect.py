"""Plan inspection through the public ``DataFrame.explain`` API.

Used by the plan tests and the bench to pin the plan shape: the number of
shuffles, joins and sorts, and whether scans prune columns and receive
pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame

OPERATORS = (
    "Exchange",
    "BroadcastExchange",
    "SortMergeJoin",
    "BroadcastHashJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "Window",
    "Sort",
    "HashAggregate",
    "SortAggregate",
    "Scan parquet",
    "Union",
)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _tree(text: str) -> list[str]:
    """The operator tree lines of a formatted plan (before the node details)."""
    lines = text.splitlines()
    start = next(i for i, line in enumerate(lines) if line.startswith("== Physical Plan"))
    out = []
    for line in lines[start + 1:]:
        if not line.strip():
            break
        out.append(line)
    # after execution AQE prints the final and the initial plan; count the
    # initial one so the numbers do not depend on whether the query ran
    initial = [i for i, line in enumerate(out) if "== Initial Plan ==" in line]
    return out[initial[0] + 1:] if initial else out


def operator_counts(df: DataFrame) -> Counter:
    """How many times each physical operator appears in the plan tree."""
    counts: Counter = Counter()
    for line in _tree(plan_text(df)):
        name = re.sub(r"^[\s:+\-|]*", "", line)
        name = re.sub(r"\s*\(\d+\)\s*$", "", name).strip()
        for op in OPERATORS:
            if name == op or name.startswith(op + " "):
                counts[op] += 1
    return counts


def shuffle_count(df: DataFrame) -> int:
    """Hash/range shuffles (broadcasts are counted separately)."""
    return operator_counts(df)["Exchange"]


def join_count(df: DataFrame) -> int:
    c = operator_counts(df)
    return sum(
        c[j]
        for j in (
            "SortMergeJoin",
            "BroadcastHashJoin",
            "ShuffledHashJoin",
            "BroadcastNestedLoopJoin",
            "CartesianProduct",
        )
    )


def scan_details(df: DataFrame) -> list[dict[str, str]]:
    """For each Parquet scan: its ``ReadSchema`` and ``PushedFilters``."""
    text = plan_text(df)
    scans = []
    for block in re.split(r"\n\(\d+\) ", text):
        if not block.startswith("Scan parquet"):
            continue
        info = {}
        for key in ("ReadSchema", "PushedFilters", "Location"):
            m = re.search(rf"^{key}: (.*)$", block, re.M)
            info[key] = m.group(1) if m else ""
        scans.append(info)
    return scans
