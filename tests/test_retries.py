"""Observed metrics stay exact when the write's tasks fail and are retried."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL


def test_metrics_exact_under_task_retries():
    probe = os.path.join(os.path.dirname(__file__), "retry_probe.py")
    r = subprocess.run([sys.executable, probe, SF_SMALL], capture_output=True, text=True,
                       timeout=900)
    assert r.returncode == 0, r.stderr[-2000:]
    out = json.loads(r.stdout.strip().splitlines()[-1])
    assert out["failed_attempts"] > 0              # tasks really failed and were retried
    assert out["failed_map_attempts"] > 0
    assert out["plain"] == out["retried"] == out["map_retried"]
    assert out["plain"]["rows_saved"] > 0
