"""Failed task attempts do not change results (separate Spark process)."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

SCRIPT = os.path.join(os.path.dirname(__file__), "scripts", "retry_check.py")


def test_results_survive_failed_task_attempts():
    out = subprocess.run(
        [sys.executable, SCRIPT, SF_SMALL], capture_output=True, text=True, timeout=600
    )
    assert "RETRY-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
