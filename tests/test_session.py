"""Results do not depend on the session: a plain session in another time zone."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import SF0001


def test_plain_session_in_another_time_zone():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "tz_job.py")
    out = subprocess.run([sys.executable, script, SF0001], capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert lines, out.stderr[-2000:]
    result = json.loads(lines[-1])
    assert result.pop("entry_rows") == 6033
    assert all(result.values()), result
