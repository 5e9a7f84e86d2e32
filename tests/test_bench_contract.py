"""bench.py prints exactly one JSON line on stdout with the driver's keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF["0.001"], BENCH_RUNS="1", BENCH_CPUS="4")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True, env=env, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    suite = {"program_audit_report", "waitlist_report", "signup_time_report", "daily_cancel_report", "staging_full_copy"}
    assert suite <= set(result["queries"])
    assert abs(result["value"] - sum(result["queries"][q] for q in suite)) < 0.01
