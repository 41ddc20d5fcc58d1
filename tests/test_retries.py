from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))


def test_results_survive_task_retries():
    proc = subprocess.run(
        [sys.executable, os.path.join(HERE, "retry_check.py"), SF_SMALL],
        capture_output=True,
        text=True,
        timeout=600,
    )
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("{")]
    assert lines, proc.stderr[-2000:]
    out = json.loads(lines[-1])
    assert out["equal"] is True
    assert out["pairs"] > 0
    assert "injected failure" in proc.stderr  # the retries really happened
