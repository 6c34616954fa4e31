"""Skew guard on real task sizes (event log): a key holding a third of the rows."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

ROWS = 600_000


def test_hot_key_never_lands_in_one_window_task():
    tool = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "skew_check.py")
    scratch = tempfile.mkdtemp(prefix="spanpack-skew-")
    out = subprocess.run([sys.executable, tool, scratch, str(ROWS)], capture_output=True, text=True, timeout=900)
    stages = [json.loads(line) for line in out.stdout.splitlines() if line.startswith("{")]
    assert stages, out.stderr[-2000:]
    day = [s for s in stages if s["plan"] == "day_level_eras"]
    naive = [s for s in stages if s["plan"] == "row_level_window"]
    join = [s for s in stages if s["plan"] == "pack_intervals_hot_day"]
    hot = ROWS // 3
    # the naive window puts the whole hot key into one task ...
    assert max(s["max_task"] for s in naive) >= hot
    # ... while in the day-level plan the busiest task stays near the average
    # (AQE may coalesce partitions at this size, so compare with the mean)
    for s in day:
        assert s["max_task"] <= 1.5 * s["total"] / s["tasks"], s
    # the default counts by id: a third of the rows on one (key, day), or copies of
    # one record, leave no task with more than half above the mean
    for name in ("default_hot_day", "default_hot_copies"):
        by_id = [s for s in stages if s["plan"] == name]
        assert len(by_id) >= 6
        for s in by_id:
            assert s["max_task"] <= max(1.5 * s["total"] / s["tasks"], ROWS / 100), s
    # a join to a lookup table sends the hot key to one task, spread_join to all
    largest = lambda plan: max((s for s in stages if s["plan"] == plan), key=lambda s: s["total"])
    assert largest("lookup_plain")["max_task"] >= hot
    spread = largest("lookup_spread")
    assert spread["total"] >= ROWS and spread["tasks"] == 16
    assert spread["max_task"] <= 1.5 * spread["total"] / spread["tasks"], spread
    # and the hot (key, day) of the row-level outputs is dealt evenly too
    for s in join:
        assert s["max_task"] <= 1.5 * s["total"] / s["tasks"], s
